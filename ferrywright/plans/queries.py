"""The registered queries. Each takes the session and the folder of the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import access, paths, values
from ..operators import copyjob, filters, identity, metadata, ordering, place, reconcile, splits, totals, trees
from ..operators.strategy import assign_splits
from ..options import SyncOptions
from ..schema import as_manifest
from ..scratch import cut, scratch_path
from ..sources import config, listing, manifest, patterns, reports
from . import derived

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

SYNC = SyncOptions(update=True, append=True)
# Small tables would fit one block; these queries show that the result does not depend on it.
SEVERAL_BLOCKS = {"min_blocks": 4}
EXCLUDED = [r".*/src1/.*", r"/src/src2/e.*", r".*/1[0-9]*\.txt", r"src.*"]
GLOBS = ["/src/src1/*/*.txt", "/src/src?/en/*[13579].txt", "/src/{src0,src2}/f?/*", "/src/*/*/1?.txt"]


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def bigint(name: str):
    return F.col(name).cast("bigint").alias(name)


def joined(name: str):
    """An array of strings as one comparable string."""
    return F.concat_ws(",", name).alias(name)


def entry_text(e):
    return F.concat_ws(":", F.lower(e["scope"]), F.lower(e["type"]), F.coalesce(e["name"], F.lit("")), e["perm"])


def planned_sync(spark: SparkSession, sf_dir: str, options: SyncOptions = SYNC) -> DataFrame:
    """What a run would do with each document."""
    src, tgt = derived.source_manifest(spark, sf_dir), derived.target_manifest(spark, sf_dir)
    content = derived.content(spark, sf_dir)
    return reconcile.reconcile(src.drop("checksum"), tgt, options, digests=lambda few: reconcile.content_digests(few, content))


def placed_documents(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    src = derived.source_manifest(spark, sf_dir)
    return place.first_fit(src, derived.region_boxes(spark, sf_dir), keep=("path",), **options)


def balanced_documents(spark: SparkSession, sf_dir: str, **options) -> tuple[DataFrame, DataFrame]:
    boxes = cut(derived.region_boxes(spark, sf_dir), "boxes")
    plan = place.plan_splits(boxes)
    placed = place.first_fit(derived.source_manifest(spark, sf_dir), boxes, with_blocks=True, **options)
    return splits.balance(placed, plan), plan


# Listing, paths and filters


@query
def manifest_totals(spark, sf_dir):
    return totals.totals(derived.with_dirs(derived.source_manifest(spark, sf_dir)))


@query
def exclude_paths(spark, sf_dir):
    return filters.exclude_paths(derived.source_manifest(spark, sf_dir), EXCLUDED).select("path", "length")


@query
def predicate_filter(spark, sf_dir):
    """Rows left by a filter of one's own, by none at all, and by one that is unknown for some rows."""
    src = derived.source_manifest(spark, sf_dir)
    own = {"none": None, "small": F.col("length") < 500, "unknown": F.when(F.col("seq") % 3 != 0, F.col("owner") == "u4")}
    kept = [filters.exclude_paths(src, predicate=p).select(F.lit(mode).alias("mode"), "path") for mode, p in own.items()]
    return kept[0].unionByName(kept[1]).unionByName(kept[2])


@query
def exclude_keys(spark, sf_dir):
    toxic = derived.table(spark, sf_dir, "labels").filter("toxic = 1").select(F.col("doc_id").alias("seq"))
    return filters.exclude_keys(derived.source_manifest(spark, sf_dir), toxic, key="seq").select("path")


@query
def relative_paths(spark, sf_dir):
    """Each directory of documents is a source of its own, listed with plain and with update rules."""
    tree = derived.with_dirs(derived.source_manifest(spark, sf_dir))
    source = F.regexp_extract("path", r"^(/src/[^/]+)", 1)
    tree = tree.withColumn("source", source)
    n_sources = tree.select("source").distinct().count()
    plain = tree.withColumn("root", paths.source_root("source", F.lit(True), n_sources, False))
    update = tree.withColumn("root", paths.source_root("source", F.lit(True), n_sources, True))
    out = None
    for mode, rows, replace in (("plain", plain, False), ("update", update, True)):
        kept = filters.suppress_roots(rows, replace)
        part = kept.select(F.lit(mode).alias("mode"), "path", paths.relative_path("root", "path").alias("rel_path"))
        out = part if out is None else out.unionByName(part)
    return out


@query
def duplicate_targets(spark, sf_dir):
    src = derived.source_manifest(spark, sf_dir)
    merged = F.concat(F.lit("/"), F.regexp_extract("path", "^/src/[^/]+/([^/]+)/", 1), F.lit("/"), F.col("seq") % 50)
    return totals.duplicates(src.withColumn("rel_path", merged))


@query
def union_manifests(spark, sf_dir):
    """Totals per root over the manifests of documents, pages and conversations."""
    docs = derived.source_manifest(spark, sf_dir).select("root", "path", "length")
    pages = derived.table(spark, sf_dir, "pages").select(
        F.lit("/web").alias("root"), F.col("url").alias("path"), F.length("html").cast("bigint").alias("length")
    )
    talks = derived.table(spark, sf_dir, "conversations").select(
        F.lit("/talk").alias("root"),
        F.concat(F.lit("/talk/"), F.col("conv_id").cast("string"), F.lit("/"), F.col("turn").cast("string")).alias("path"),
        F.length("text").cast("bigint").alias("length"),
    )
    every = ordering.union_manifests(docs, pages, talks)
    return every.groupBy("root").agg(F.count("*").alias("paths"), F.sum("length").alias("bytes"))


@query
def distinct_filesystems(spark, sf_dir):
    return totals.distinct_filesystems(derived.table(spark, sf_dir, "pages"), "url")


@query
def qualified_paths(spark, sf_dir):
    pages = derived.table(spark, sf_dir, "pages").select("page_id", "url")
    bare = F.when(F.col("page_id") % 2 == 1, paths.uri_path("url")).otherwise(F.col("url"))
    return pages.select("page_id", paths.qualify(bare, "https://default.example.org/").alias("qualified"), bare.alias("given"))


@query
def match_globs(spark, sf_dir):
    return patterns.match_globs(derived.source_manifest(spark, sf_dir), GLOBS).select("glob", "path")


@query
def unmatched_globs(spark, sf_dir):
    return patterns.unmatched_globs(derived.source_manifest(spark, sf_dir), [*GLOBS, "/src/*/none/*", "/src/*"])


@query
def match_many_globs(spark, sf_dir):
    """Every fifth document gives a pattern: names in its directory that begin with its number."""
    named = F.concat(F.regexp_extract("path", r"^(.*)\.txt$", 1), F.lit("*.t?t"))
    src = derived.source_manifest(spark, sf_dir)
    index = patterns.pattern_index(src.filter("seq % 5 = 0").select(named.alias("glob")))
    return patterns.match_many(src, index)


@query
def exclude_many_filters(spark, sf_dir):
    """A filter file with a line for every source and language, and one for all directories, applied as an index."""
    docs = derived.table(spark, sf_dir, "documents").select("source", "lang").distinct()
    lines = docs.select(F.concat(F.lit("/src/"), "source", F.lit("/"), "lang", F.lit("/[0-9]*[13]\\.txt")).alias("line"))
    path = scratch_path(spark, "filters")
    lines.unionByName(docs.select(F.lit(".*/7[0-9]+\\.txt").alias("line")).distinct()).write.text(path)
    index = patterns.pattern_index(patterns.read_list_file(spark, path), "path", globs=False).withColumnRenamed("path", "glob")
    return patterns.exclude_many(derived.source_manifest(spark, sf_dir), index).select("path")


@query
def sort_manifest(spark, sf_dir):
    src = derived.source_manifest(spark, sf_dir).select("rel_path", "length")
    return ordering.number_rows(src, "rel_path", "idx", **SEVERAL_BLOCKS)


@query
def randomize(spark, sf_dir):
    src = derived.source_manifest(spark, sf_dir).select("path", "length")
    return ordering.randomize(src, 42, **SEVERAL_BLOCKS)


@query
def list_tree(spark, sf_dir):
    """The documents as files, written by tasks and listed again."""
    found, _ = listing.list_tree(spark, [derived.write_tree(spark, sf_dir)], replace_content=True)
    return found.select("rel_path", "is_dir", "length")


@query
def list_file_sources(spark, sf_dir):
    """Patterns for the source directories go into a list file, from which the tree is listed."""
    root = derived.write_tree(spark, sf_dir)
    names = derived.table(spark, sf_dir, "documents").select(F.substring("source", 1, 4).alias("head")).distinct()
    list_file = scratch_path(spark, "sources")
    names.select(F.concat(F.lit(f"{root}/"), "head", F.lit("*"))).write.text(list_file)
    sources = listing.expand_sources(spark, patterns.read_list_file(spark, list_file))
    found, _ = listing.list_tree(spark, sources.select("path"))
    return found.select("rel_path", "is_dir", "length")


@query
def checked_roots(spark, sf_dir):
    """Which of the folders that pages name as theirs, or documents have, are among the documents' files."""
    root = derived.write_files(spark, sf_dir)
    docs = derived.table(spark, sf_dir, "documents").select("source", "lang").distinct()
    names = F.explode(F.array(F.concat(F.lit("source="), "source"), F.concat(F.lit("source="), "source", F.lit("/lang="), "lang"), F.concat(F.lit("lang="), "lang")))
    wanted = docs.select(names.alias("name")).distinct().select(F.concat(F.lit(f"{root}/"), "name").alias("path"))
    found = listing.check_roots(spark, wanted)
    return found.select(F.substring("path", len(root) + 2, 1000).alias("name"), "is_dir", "error")


@query
def manifest_defaults(spark, sf_dir):
    """A table with gaps brought into the manifest form, stored and read again."""
    docs = derived.table(spark, sf_dir, "documents").withColumns(
        {
            "owner": F.when(F.col("doc_id") % 4 != 0, F.col("source")),
            "group": F.when(F.col("doc_id") % 6 != 0, F.col("lang")),
            "perm": F.when(F.col("doc_id") % 5 != 0, F.lit(384)),
            "is_dir": F.col("doc_id") % 10 == 0,
        }
    )
    mapping = {"path": derived.doc_name(), "length": "n_chars", "seq": "doc_id"}
    path = scratch_path(spark, "manifest")
    manifest.write_manifest(as_manifest(docs, mapping), path)
    stored = manifest.read_manifest(spark, path)
    return stored.select(
        bigint("seq"), "path", "is_dir", "length", "owner", F.col("group").alias("grp"), bigint("perm"), "chunk_length"
    )


# Reconciliation


@query
def sync_actions(spark, sf_dir):
    return planned_sync(spark, sf_dir).select("rel_path", "action", "length", "tgt_length")


@query
def sync_counters(spark, sf_dir):
    return totals.counters(planned_sync(spark, sf_dir))


@query
def sync_modes(spark, sf_dir):
    """Actions and bytes under each combination of options."""
    modes = {
        "plain": SyncOptions(),
        "overwrite": SyncOptions(overwrite=True),
        "update": SyncOptions(update=True),
        "update_blocks": SyncOptions(update=True, preserve="b"),
        "update_lengths": SyncOptions(update=True, skip_crc=True),
        "update_strict": SyncOptions(update=True, strict_checksums=True),
    }
    src = derived.source_manifest(spark, sf_dir)
    # The target is joined once; a mode is one more conditional aggregate.
    rows = reconcile.match_target(src, derived.target_manifest(spark, sf_dir))
    action = F.create_map(*[v for m, o in modes.items() for v in (F.lit(m), reconcile.action_column(o))])
    per_row = rows.select("length", F.explode(action).alias("mode", "action"))
    return per_row.groupBy("mode", "action").agg(F.count("*").alias("files"), F.sum("length").alias("bytes"))


@query
def append_candidates(spark, sf_dir):
    src, tgt = derived.source_manifest(spark, sf_dir), derived.target_manifest(spark, sf_dir)
    found = reconcile.append_candidates(src, tgt, SYNC)
    return reconcile.prefix_checksums(found, derived.content(spark, sf_dir))


@query
def vanished_sources(spark, sf_dir):
    src = derived.source_manifest(spark, sf_dir)
    return reconcile.vanished_sources(src, src.filter(F.col("seq") % 23 != 0)).select("path")


@query
def verify_copy(spark, sf_dir):
    src, tgt = derived.source_manifest(spark, sf_dir), derived.target_manifest(spark, sf_dir)
    return reconcile.verify(src, tgt)


@query
def extraneous_targets(spark, sf_dir):
    src, tgt = derived.source_manifest(spark, sf_dir), derived.target_manifest(spark, sf_dir)
    return reconcile.extraneous_targets(src, tgt).select("rel_path", "length")


@query
def in_sync(spark, sf_dir):
    src, tgt = derived.source_manifest(spark, sf_dir), derived.target_manifest(spark, sf_dir)
    return reconcile.in_sync(src, tgt)


@query
def snapshot_diff(spark, sf_dir):
    old, new = derived.old_snapshot(spark, sf_dir), derived.new_snapshot(spark, sf_dir)
    return reconcile.snapshot_diff(old, new, file_id="file_id")


@query
def snapshot_diff_by_path(spark, sf_dir):
    old, new = derived.old_snapshot(spark, sf_dir), derived.new_snapshot(spark, sf_dir)
    return reconcile.snapshot_diff(old, new)


@query
def snapshot_replay(spark, sf_dir):
    old, new = derived.old_snapshot(spark, sf_dir), derived.new_snapshot(spark, sf_dir)
    return reconcile.replay_order(reconcile.snapshot_diff(old, new, file_id="file_id"))


@query
def snapshot_copy_list(spark, sf_dir):
    old, new = derived.old_snapshot(spark, sf_dir), derived.new_snapshot(spark, sf_dir)
    return reconcile.copy_list(reconcile.snapshot_diff(old, new, file_id="file_id"))


@query
def snapshot_replay_plan(spark, sf_dir):
    """Steps by which a target takes over moves and deletions, through names of their own."""
    return trees.replay_plan(derived.old_tree(spark, sf_dir), derived.new_tree(spark, sf_dir))


@query
def created_content(spark, sf_dir):
    """What has to be copied into directories that are new, without what was moved there."""
    new = derived.new_tree(spark, sf_dir)
    found = trees.created_content(new, trees.replay_plan(derived.old_tree(spark, sf_dir), new))
    return found.select("rel_path", "is_dir", "length", "root")


@query
def deletion_roots(spark, sf_dir):
    """Deletions that a mirror of the new tree needs on a target that still holds the old one.

    The source listing lacks some directories of which it has files.
    """
    src = derived.new_tree(spark, sf_dir).filter("not (is_dir and rel_path like '/src1%')")
    return trees.deletion_roots(src, derived.old_tree(spark, sf_dir))


# Identities and metadata


@query
def identities_distinct(spark, sf_dir):
    return identity.collect_identities(derived.source_with_acl(spark, sf_dir))


@query
def identity_map_file(spark, sf_dir):
    """Identities found, merged with known translations, stored as JSON and read again."""
    found = identity.collect_identities(derived.source_with_acl(spark, sf_dir))
    path = scratch_path(spark, "identity-map")
    config.write_identities(identity.merge_identities(found, derived.identity_map(spark, sf_dir)), path)
    return config.read_identities(spark, path)


@query
def unmapped_identities(spark, sf_dir):
    found = identity.collect_identities(derived.source_with_acl(spark, sf_dir))
    return identity.unmapped_identities(found, derived.identity_map(spark, sf_dir))


@query
def identity_translation(spark, sf_dir):
    src = derived.source_with_acl(spark, sf_dir).select("rel_path", "owner", "group", "acl")
    out = identity.translate_identities(src, derived.identity_map(spark, sf_dir))
    acl = F.concat_ws(",", F.transform("acl", entry_text))
    return out.select("rel_path", "owner", F.col("group").alias("grp"), acl.alias("acl"))


@query
def logical_acl(spark, sf_dir):
    src = derived.source_with_acl(spark, sf_dir)
    full = src.select("rel_path", F.posexplode(access.logical_acl("perm", "acl")).alias("pos", "entry"))
    return full.select("rel_path", bigint("pos"), entry_text(F.col("entry")).alias("entry"))


@query
def acl_transfer_plan(spark, sf_dir):
    src = derived.source_with_acl(spark, sf_dir)
    tgt = derived.target_manifest(spark, sf_dir)
    # Every sixth target has the ACL and permission of its source already, but not the translated names.
    held = derived.acl_lists(spark, sf_dir).filter(F.col("seq") % 6 == 0).withColumnRenamed("seq", "doc_id")
    tgt = tgt.join(held, "doc_id", "left")
    plan = identity.acl_transfer_plan(src, tgt, derived.identity_map(spark, sf_dir))
    acl = F.concat_ws(",", F.transform("acl", entry_text))
    return plan.select("rel_path", "status", "owner", F.col("group").alias("grp"), acl.alias("acl"), joined("setters"))


@query
def acl_merged(spark, sf_dir):
    """Full ACLs after names were mapped to three teams, each team once per scope."""
    src = derived.source_with_acl(spark, sf_dir)
    names = src.select(F.explode("acl").alias("e")).select(F.col("e.name").alias("local_identity")).filter("local_identity is not null").distinct()
    team = F.concat(F.lit("team-"), (F.substring("local_identity", F.lit(2), F.lit(9)).cast("int") % 3).cast("string"))
    full = src.select("rel_path", "owner", "group", access.logical_acl("perm", "acl").alias("acl"))
    out = identity.translate_identities(full, names.withColumn("cloud_identity", team))
    return out.select("rel_path", F.concat_ws(",", F.transform(access.merge_entries("acl"), entry_text)).alias("acl"))


@query
def preserve_plan(spark, sf_dir):
    src, tgt = derived.source_manifest(spark, sf_dir), derived.target_manifest(spark, sf_dir)
    plan = metadata.preserve_plan(src, tgt, SyncOptions(preserve="rbugpct").preserve)
    return plan.select("rel_path", joined("setters"))


@query
def create_attributes(spark, sf_dir):
    """Replication and block size each copied document is created with, for three sets of attributes."""
    src = derived.source_manifest(spark, sf_dir)
    out = None
    for letters in ("u", "rb", "c"):
        wanted = metadata.create_attributes(src, SyncOptions(preserve=letters), replication=2, block_size=derived.MB)
        part = wanted.select(F.lit(letters).alias("letters"), "rel_path", bigint("want_replication"), "want_block_size")
        out = part if out is None else out.unionByName(part)
    return out


@query
def xattr_filter(spark, sf_dir):
    rows = derived.xattr_manifest(spark, sf_dir)
    out = None
    for mode, raw, regular in (("raw", True, False), ("regular", False, True), ("both", True, True), ("none", False, False)):
        kept = rows.select("rel_path", F.explode(access.filter_xattrs("xattrs", raw=raw, regular=regular)).alias("name", "v"))
        part = kept.select(F.lit(mode).alias("mode"), "rel_path", "name", F.decode("v", "utf-8").alias("value"))
        out = part if out is None else out.unionByName(part)
    return out


@query
def xattr_plan(spark, sf_dir):
    src, tgt = derived.xattr_manifest(spark, sf_dir), derived.xattr_manifest(spark, sf_dir, target=True)
    plan = metadata.preserve_plan(src, tgt, {"xattr"}, raw_xattrs=True)
    return plan.select("rel_path", joined("setters"))


@query
def attribute_sets(spark, sf_dir):
    letters = F.concat(
        F.when(F.col("doc_id") % 2 == 0, "t").otherwise("p"),
        F.when(F.col("doc_id") % 3 == 0, "r").otherwise("b"),
        F.when(F.col("doc_id") % 5 == 0, "A").otherwise("u"),
        F.lit("p"),
    )
    docs = derived.table(spark, sf_dir, "documents").select("doc_id", letters.alias("letters"))
    names = docs.withColumn("names", values.attribute_names("letters"))
    return names.select("doc_id", joined("names"), values.attribute_letters("names").alias("packed"))


# Boxes and placement


@query
def boxes_config(spark, sf_dir):
    """A target configuration written as JSON, with a box per nation sized by its customers, and read again."""
    boxes = derived.nation_boxes(spark, sf_dir)
    key = F.col("box_id")
    box = F.struct(
        F.col("n_name").alias("boxDns"),
        F.when(key % 2 == 0, "key").otherwise("").alias("accountKey"),
        F.when(key % 4 != 0, F.col("n_customers") * 1000).otherwise(F.lit(-1)).alias("sizeInBytes"),
        F.when(key % 3 == 0, "own").otherwise("").alias("container"),
    )
    # One entry per nation: a list of fixed length.
    listed = F.transform(F.array_sort(F.collect_list(F.struct("box_id", box.alias("b")))), lambda x: x["b"])
    text = F.to_json(F.struct(F.lit("shared").alias("container"), listed.alias("boxes")))
    path = scratch_path(spark, "boxes")
    boxes.agg(text.alias("value")).write.text(path)
    return config.read_boxes(spark, path).select(bigint("box_id"), "dns", "container", "size_bytes", "target_uri")


@query
def plan_splits(spark, sf_dir):
    boxes = derived.nation_boxes(spark, sf_dir)
    out = None
    for factors, limit in (("intended", 20), ("intended", 1000), ("observed", 100)):
        plan = place.plan_splits(boxes, max_splits=limit, factors=factors)
        part = plan.select(
            F.lit(factors).alias("factors"),
            F.lit(limit).cast("bigint").alias("max_splits"),
            bigint("box_id"),
            bigint("box_rank"),
            bigint("n_splits"),
            bigint("first_split"),
        )
        out = part if out is None else out.unionByName(part)
    return out


@query
def first_fit_placement(spark, sf_dir):
    return placed_documents(spark, sf_dir, **SEVERAL_BLOCKS).select("seq", "length", bigint("box_id"))


@query
def skipped_files(spark, sf_dir):
    return reports.skipped_report(placed_documents(spark, sf_dir))


@query
def balance_lpt(spark, sf_dir):
    balanced, _ = balanced_documents(spark, sf_dir, **SEVERAL_BLOCKS)
    return balanced.select("seq", bigint("box_id"), bigint("split_id"))


@query
def placement_report(spark, sf_dir):
    balanced, plan = balanced_documents(spark, sf_dir)
    report = totals.placement_report(balanced, plan)
    return report.select(bigint("box_id"), bigint("split_id"), "records", "bytes", "space_left")


@query
def placement_orders(spark, sf_dir):
    """Orders placed on five boxes, one without limit, and balanced over their splits."""
    boxes = cut(derived.order_boxes(spark, sf_dir), "boxes")
    placed = place.first_fit(derived.order_manifest(spark, sf_dir), boxes, with_blocks=True)
    return splits.balance(placed, place.plan_splits(boxes)).select(
        "seq", "length", bigint("box_id"), bigint("split_id")
    )


@query
def target_uris(spark, sf_dir):
    """Where each placed document goes."""
    boxes = derived.region_boxes(spark, sf_dir).select(
        "box_id", paths.box_uri("dns", F.when(F.col("box_id") % 2 == 0, "key"), F.lit("files")).alias("base")
    )
    src = derived.source_manifest(spark, sf_dir)
    placed = place.first_fit(src, derived.region_boxes(spark, sf_dir), keep=("rel_path",)).join(F.broadcast(boxes), "box_id")
    return placed.select("seq", paths.target_uri("base", "rel_path").alias("target_uri"))


@query
def uniform_split(spark, sf_dir):
    src = derived.source_manifest(spark, sf_dir)
    return splits.uniform_split(src, 20, keep=("rel_path",), **SEVERAL_BLOCKS).select("seq", "rel_path", bigint("split_id"))


@query
def uniform_split_orders(spark, sf_dir):
    orders = derived.order_manifest(spark, sf_dir).withColumnRenamed("length", "chunk_length")
    cuts = splits.uniform_split(orders, 50)
    return cuts.groupBy("split_id").agg(
        F.count("*").alias("records"), F.sum("chunk_length").alias("bytes"), F.min("seq").alias("first_seq")
    ).select(bigint("split_id"), "records", "bytes", "first_seq")


@query
def strategy_splits(spark, sf_dir):
    """Documents divided by each strategy, with the concurrency that a run's options give."""
    boxes, src = cut(derived.region_boxes(spark, sf_dir), "boxes"), derived.source_manifest(spark, sf_dir)
    out = None
    for strategy, options in (("first_fit", SyncOptions()), ("uniform", SyncOptions(max_maps=20)), ("dynamic", SyncOptions(max_maps=7))):
        given = assign_splits(src, strategy, boxes=boxes, options=options)
        part = given.select(F.lit(strategy).alias("strategy"), "seq", bigint("split_id"))
        out = part if out is None else out.unionByName(part)
    return out


@query
def named_splits(spark, sf_dir):
    """The names of splits, and in whole seconds when the last of each one's files was changed."""
    src = derived.source_manifest(spark, sf_dir)
    name = F.concat(F.lit("chunk-"), values.padded_id(F.col("seq") % 250))
    return src.groupBy(name.alias("name")).agg(F.unix_seconds(F.max(values.timestamp_millis(F.col("mtime") + F.col("length")))).alias("changed"))


@query
def deal_chunks(spark, sf_dir):
    src = derived.source_manifest(spark, sf_dir)
    return splits.deal_chunks(src, 7, keep=("rel_path",), **SEVERAL_BLOCKS).select("rel_path", bigint("idx"), bigint("chunk_id"))


@query
def chunk_files(spark, sf_dir):
    parts = splits.chunk_files(derived.source_manifest(spark, sf_dir).select("path", "length"), 1000)
    name = paths.chunk_path("path", "chunk_offset", "chunk_length")
    size = paths.size_to_copy("length", "chunk_length")
    return parts.select(name.alias("part"), "chunk_offset", size.alias("bytes"))


def _some_parts(spark, sf_dir):
    """Parts of documents as a copy may leave them: some lost, some copied twice, some too long."""
    parts = splits.chunk_files(derived.source_manifest(spark, sf_dir).select("path", "length", "seq"), 1000)
    first = F.col("chunk_offset") == 0
    kept = parts.filter(~((F.col("seq") % 7 == 0) & first & (F.col("length") > 1500)) & (F.col("seq") % 29 != 0))
    longer = F.when((F.col("seq") % 13 == 0) & first, F.col("chunk_length") + 10).otherwise(F.col("chunk_length"))
    kept = kept.withColumn("chunk_length", longer)
    return kept.unionByName(kept.filter((F.col("seq") % 11 == 0) & first))


@query
def part_coverage(spark, sf_dir):
    files = derived.source_manifest(spark, sf_dir).select("path", "length")
    return splits.part_coverage(files, _some_parts(spark, sf_dir))


@query
def merged_ranges(spark, sf_dir):
    return splits.merged_ranges(_some_parts(spark, sf_dir))


# Reports


@query
def human_bytes(spark, sf_dir):
    size = F.col("n_chars") * F.element_at(F.array(*[F.lit(1024**k) for k in range(5)]), (F.col("doc_id") % 5).cast("int") + 1)
    return derived.table(spark, sf_dir, "documents").select("doc_id", values.human_bytes(size).alias("size"))


@query
def copy_progress(spark, sf_dir):
    rows = planned_sync(spark, sf_dir, SyncOptions(update=True))
    done = F.coalesce("tgt_length", F.lit(0))
    return rows.select("rel_path", (values.percent(done, "length") * 10).cast("bigint").alias("per_mille"))


@query
def action_log(spark, sf_dir):
    rows = planned_sync(spark, sf_dir).withColumns(
        {
            "target_uri": paths.target_uri(F.lit("file:/box/"), "rel_path"),
            "status": F.when(F.col("action") == "CONFLICT", "FAIL").otherwise("OK"),
            "error": F.when(F.col("action") == "CONFLICT", "type differs"),
        }
    )
    return reports.action_log(rows, verbose=True)


@query
def throughput_report(spark, sf_dir):
    timed = derived.source_manifest(spark, sf_dir).select(
        F.col("length").alias("bytes_copied"),
        (F.col("seq") % 7).alias("split_id"),
        F.col("mtime").alias("started_ms"),
        (F.col("mtime") + F.col("length")).alias("finished_ms"),
    )
    return totals.throughput_report(timed)


# The copy job


def run_copy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents as files, listed, reconciled with an empty target, placed on two folders, copied."""
    found, _ = listing.list_tree(spark, [derived.write_tree(spark, sf_dir)], replace_content=True)
    src = ordering.number_rows(found.select("path", "rel_path", "is_dir", "length"))
    base = scratch_path(spark, "target")
    half = src.agg(F.sum("length")).first()[0] // 2
    boxes = spark.createDataFrame([(0, half, f"{base}/a"), (1, None, f"{base}/b")], "box_id int, size_bytes bigint, uri string")
    placed = place.first_fit(src, boxes, keep=("path", "rel_path", "is_dir"), with_blocks=True)
    balanced = splits.balance(placed, place.plan_splits(boxes), keep=("path", "rel_path", "is_dir"))
    empty = src.select("rel_path", "is_dir", "length").limit(0)
    options = SyncOptions(overwrite=True)
    plan = reconcile.reconcile(balanced, empty, options).join(F.broadcast(boxes.select("box_id", "uri")), "box_id")
    plan = plan.withColumn("target_uri", paths.target_uri("uri", "rel_path"))
    return copyjob.enforce_failures(copyjob.copy_files(plan, options), options)


@query
def copy_files(spark, sf_dir):
    return run_copy(spark, sf_dir).select("rel_path", "action", "status", "bytes_copied", "checksum")


@query
def copy_counters(spark, sf_dir):
    return totals.counters(run_copy(spark, sf_dir))



@query
def copy_outcomes(spark, sf_dir):
    """A run over files that Spark wrote, of which the target has some already, some half, and folders in place of some.

    Some files are lost between planning and copying: they are tried three times, and reported. Per folder.
    """
    listed, _ = listing.list_tree(spark, [derived.write_files(spark, sf_dir)], replace_content=True)
    files = filters.exclude_paths(listed, [r".*/[._][^/]*"]).filter("not is_dir").select("path", "rel_path", "is_dir", "length")
    source, lang = (F.regexp_extract("rel_path", f"{name}=([^/]*)/", 1) for name in ("source", "lang"))
    base = scratch_path(spark, "target")
    numbered = files.withColumns({"source": source, "lang": lang, "split_id": (F.crc32(F.col("rel_path").cast("binary")) % 16).cast("int")})
    numbered = cut(numbered.withColumn("target_uri", paths.target_uri(F.lit(base), "rel_path")), "numbered")

    clash = (F.col("lang") == "es") & (F.col("source") == "src4")
    before = numbered.filter(clash | (F.col("lang") == "de")).withColumn("action", F.when(clash, "MKDIR").otherwise("OVERWRITE"))
    copyjob.enforce_failures(copyjob.copy_files(before.withColumn("tgt_length", F.lit(None).cast("bigint")), SyncOptions()), SyncOptions())
    derived.write_halves(numbered.filter("lang = 'fr'"))

    held, _ = listing.list_tree(spark, [base], replace_content=True)
    digests = copyjob.file_checksums(held.filter("not is_dir"))
    options = SyncOptions(update=True, append=True, ignore_failures=True)
    plan = reconcile.reconcile(numbered, held.join(digests, "rel_path", "left"), options, digests=copyjob.file_digests)
    lost = (F.col("lang") == "en") & (F.col("source") == "src1")
    plan = plan.withColumn("path", F.when(lost, F.concat("path", F.lit(".lost"))).otherwise(F.col("path")))
    # Ignoring failures passes over files that can't be read; folders in the way would end the run without ``all_io``.
    done = copyjob.enforce_failures(copyjob.copy_files(plan, options, pause=0.01), options, all_io=True)
    there = F.col("bytes_copied") + F.when(F.col("status") == "OK", F.coalesce("tgt_length", F.lit(0))).otherwise(F.lit(0))
    return done.groupBy(source.alias("source"), lang.alias("lang"), "action", "status", "error_class").agg(
        F.max("attempts").cast("bigint").alias("attempts"), F.sum("length").alias("bytes"), F.sum(there).alias("bytes_there")
    )
