"""Replay plans, created content and deletion roots against literal walks over small trees."""

import random

import pytest

from ferrywright.operators import trees

SCHEMA = "file_id string, rel_path string, is_dir boolean, length bigint"


def frame(spark, tree):
    """``tree``: id -> (path, is_dir, length)."""
    return spark.createDataFrame([(i, *v) for i, v in tree.items()], SCHEMA).repartition(4)


def below(path, root):
    return path == root or path.startswith(root + "/")


def replay(tree, steps):
    """Take the steps one by one on a tree of paths; moving a directory takes along what is below it."""
    at = {path: i for i, (path, _, _) in tree.items()}
    for s in sorted(steps, key=lambda s: (s.phase, s.wave, s.op, s.source or "", s.target or "")):
        if s.op == "MKDIR":
            assert s.target not in at
            at[s.target] = None
        elif s.op == "REMOVE":
            assert s.source in at
            at = {p: i for p, i in at.items() if not below(p, s.source)}
        else:
            assert s.source in at and not any(below(p, s.target) for p in at), s
            assert s.op == "STASH" or s.target.rfind("/") == 0 or s.target[: s.target.rfind("/")] in at
            at = {(s.target + p[len(s.source) :] if below(p, s.source) else p): i for p, i in at.items()}
    return at


def check_replay(spark, old, new):
    steps = trees.replay_plan(frame(spark, old), frame(spark, new)).collect()
    got = replay(old, steps)
    made = {s.target for s in steps if s.op == "MKDIR"}
    assert made == {p for i, (p, d, _) in new.items() if i not in old and d}
    assert {p: i for p, i in got.items() if i is not None} == {new[i][0]: i for i in new if i in old}
    return steps


D, F_ = (True, 0), (False, 5)


def test_swap_circle_and_reused_name(spark):
    old = {"a": ("/a", *D), "b": ("/b", *D), "fa": ("/a/x", *F_), "fb": ("/b/x", *F_)}
    old |= {"p": ("/p", *F_), "q": ("/q", *F_), "r": ("/r", *F_), "gone": ("/gone", *F_), "mover": ("/mover", *F_)}
    new = {"a": ("/b", *D), "b": ("/a", *D), "fa": ("/b/x", *F_), "fb": ("/a/x", *F_)}
    new |= {"p": ("/q", *F_), "q": ("/r", *F_), "r": ("/p", *F_), "mover": ("/gone", *F_)}
    steps = check_replay(spark, old, new)
    assert sum(s.op == "PLACE" for s in steps) == 6  # the files below a and b go along
    assert sum(s.op == "REMOVE" for s in steps) == 1


def test_moves_out_of_and_into_moved_directories(spark):
    old = {"a": ("/a", *D), "ab": ("/a/b", *D), "abc": ("/a/b/c", *F_), "ax": ("/a/x", *F_), "z": ("/z", *F_)}
    new = {"ab": ("/b", *D), "a": ("/b/a", *D), "abc": ("/b/a/c", *F_), "ax": ("/b/a/x", *F_), "z": ("/b/a/z", *F_)}
    steps = check_replay(spark, old, new)
    assert {s.source for s in steps if s.op == "STASH"} == {"/a", "/a/b", "/a/b/c", "/z"}


def test_a_replaced_directory_keeps_its_content(spark):
    old = {"d": ("/d", *D), "x": ("/d/x", *F_), "y": ("/d/y", *F_)}
    new = {"e": ("/d", *D), "x": ("/d/x", *F_)}
    steps = check_replay(spark, old, new)
    assert {s.op for s in steps} == {"STASH", "REMOVE", "MKDIR", "PLACE"}
    assert {s.source for s in steps if s.op == "STASH"} == {"/d", "/d/x"}  # y goes with d


def test_nothing_to_do_and_empty_trees(spark):
    old = {"a": ("/a", *D), "x": ("/a/x", *F_)}
    assert trees.replay_plan(frame(spark, old), frame(spark, old)).count() == 0
    empty = spark.createDataFrame([], SCHEMA)
    assert trees.replay_plan(empty, empty).count() == 0
    assert [s.op for s in check_replay(spark, {}, old)] == ["MKDIR"]
    assert sorted(s.op for s in check_replay(spark, old, {})) == ["REMOVE", "STASH"]


def random_tree(rng, n):
    tree, dirs = {}, [""]
    for i in range(n):
        path, is_dir = f"{rng.choice(dirs)}/{rng.choice('abcde')}{rng.randrange(4)}", rng.random() < 0.5
        if path not in {p for p, _, _ in tree.values()}:
            tree[f"i{i}"] = (path, is_dir, 0 if is_dir else rng.randrange(100))
            dirs += [path] if is_dir else []
    return tree


def reshuffled(rng, tree):
    """The same files and directories in another tree: any directory may end up below any other, some go, some are new."""
    kept = [i for i in tree if rng.random() < 0.85]
    rng.shuffle(kept)
    out, dirs, used = {}, [""], set()
    items = [(i, tree[i][1], tree[i][2]) for i in kept] + [(f"n{k}", rng.random() < 0.6, 3) for k in range(6)]
    for i, is_dir, length in items:
        stay = tree[i][0] if i in tree else None
        if stay and rng.random() < 0.6 and stay not in used and stay[: stay.rfind("/")] in dirs:
            path = stay
        else:
            path = f"{rng.choice(dirs)}/{rng.choice('abcde')}{rng.randrange(4)}"
        if path not in used:
            used.add(path)
            out[i] = (path, is_dir, length)
            dirs += [path] if is_dir else []
    return out


@pytest.mark.parametrize("seed", range(6))
def test_random_trees(spark, seed):
    rng = random.Random(seed)
    old = random_tree(rng, 40)
    new = reshuffled(rng, old)
    steps = check_replay(spark, old, new)
    plan = trees.replay_plan(frame(spark, old), frame(spark, new))
    # A literal walk from each created directory, which doesn't enter what was moved there.
    made = {s.target for s in steps if s.op == "MKDIR"}
    moved = {s.target for s in steps if s.op == "PLACE"}
    want = set()
    for root in made:
        todo = [root]
        while todo:
            at = todo.pop()
            want.add((at, root))
            children = [p for p, _, _ in new.values() if p[: p.rfind("/")] == at]
            todo += [p for p in children if p not in moved and p not in made]
    got = {(r.rel_path, r.root) for r in trees.created_content(frame(spark, new), plan).collect()}
    assert got == want


def plain_roots(src, tgt):
    kept = {p for p, _, _ in src.values()}
    rows = {p: (d, n) for p, d, n in tgt.values()}
    gone = {p for p in rows if not any(below(k, p) for k in kept)}
    roots = {p for p in gone if not any(p != q and rows[q][0] and below(p, q) for q in gone)}
    return {(r, rows[r][0], sum(below(p, r) for p in gone), sum(rows[p][1] for p in gone if below(p, r))) for r in roots}


@pytest.mark.parametrize("seed", range(4))
def test_deletion_roots(spark, seed):
    rng = random.Random(100 + seed)
    tgt = random_tree(rng, 60)
    src = {i: v for i, v in tgt.items() if rng.random() < (0.3 if v[1] else 0.15)}  # files whose directories aren't listed
    src["top"] = ("", True, 0)
    got = {(r.rel_path, r.is_dir, r.entries, r.bytes) for r in trees.deletion_roots(frame(spark, src), frame(spark, tgt)).collect()}
    assert got == plain_roots(src, tgt)
    kept = {p for p, _, _ in src.values()}
    assert not any(below(k, r[0]) for r in got for k in kept)


def test_deletion_of_everything_and_of_nothing(spark):
    tree = {"a": ("/a", *D), "x": ("/a/x", *F_), "y": ("/y", *F_)}
    empty = spark.createDataFrame([], SCHEMA)
    got = {tuple(r) for r in trees.deletion_roots(empty, frame(spark, tree)).select("rel_path", "entries", "bytes").collect()}
    assert got == {("/a", 2, 5), ("/y", 1, 5)}
    assert trees.deletion_roots(frame(spark, tree), frame(spark, tree)).count() == 0
    assert trees.deletion_roots(frame(spark, tree), empty).count() == 0


def test_topmost_and_nearest_mark(spark):
    rows = spark.createDataFrame([("/a/b/c",), ("/a",), ("/z",)], "rel_path string")
    marks = spark.createDataFrame([("/a", 1), ("/a/b", 2)], "rel_path string, n int")
    near = {tuple(r) for r in trees.marked_ancestors(rows, marks).collect()}
    assert near == {("/a/b/c", "/a/b", 2), ("/a", "/a", 1)}
    top = {tuple(r) for r in trees.marked_ancestors(rows, marks, own=False, nearest=False).collect()}
    assert top == {("/a/b/c", "/a", 1)}
