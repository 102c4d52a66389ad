"""SQL that gives the same results as the registered queries, written for DuckDB over the given tables."""

from __future__ import annotations

NAME = "concat('/',source,'/',lang,'/',cast(doc_id as varchar),'.txt')"

SRC = f"""src as (
 select doc_id as seq, concat('/src',{NAME}) as path, {NAME} as rel_path, n_chars as length,
  doc_id % 3 + 1 as replication, case when doc_id % 4 = 0 then 67108864 else 134217728 end as block_size,
  1700000000000 + doc_id*1000 as mtime, concat('u',doc_id % 17) as owner, concat('g',doc_id % 5) as grp,
  case when doc_id % 3 = 0 then 420 else 384 end as perm, md5(text) as checksum
 from documents)"""

TGT = f"""tgt as (
 select doc_id, {NAME} as rel_path, doc_id % 97 = 1 as is_dir, tlen as length, 3 as replication, 134217728 as block_size,
  concat('u',doc_id % 16) as owner, concat('g',doc_id % 5) as grp,
  case when doc_id % 3 = 0 then 420 else 416 end as perm,
  case when doc_id % 13 = 0 then null when doc_id % 11 = 0 then md5(concat(text,'!'))
   else md5(substring(text,1,cast(tlen as int))) end as checksum
 from (select *, case when doc_id % 7 = 0 and n_chars > 100 then n_chars - 100 else n_chars end as tlen from documents) d
 where doc_id % 5 <> 0
 union all
 select doc_id, concat('/old/',doc_id,'.txt'), false, n_chars, 3, 134217728, 'u0','g0',420, md5(text)
 from documents where doc_id % 19 = 0)"""

DIRS = """dirs as (
 select distinct concat('/',source) as rel_path from documents
 union all select distinct concat('/',source,'/',lang) from documents)"""

SYNC = f"""{SRC}, {TGT}, sync as (
 select s.*, t.length as tgt_length,
  case when t.rel_path is not null and t.is_dir then 'CONFLICT'
       when t.rel_path is null then 'OVERWRITE'
       when t.length = s.length and coalesce(s.checksum = t.checksum, true) then 'SKIP'
       when t.length < s.length and md5(substring(d.text,1,cast(t.length as int))) = t.checksum then 'APPEND'
       else 'OVERWRITE' end as action
 from src s join documents d on d.doc_id = s.seq left join tgt t on s.rel_path = t.rel_path)"""

ENTRY = """lower(case when event_id % 2 = 0 then 'ACCESS' else 'DEFAULT' end) as scope,
  case when event_type in ('view','click') then 'user' else 'group' end as type,
  case when event_id % 10 < 8 then concat('p', user_id % 23) end as name,
  case when event_type = 'error' then '---' when event_type = 'view' then 'r--' else 'rwx' end as perm"""

ACL = f"entries as (select event_id // 10 as seq, event_id as n, {ENTRY} from events)"

IDENTITIES = """idmap as (
 select concat('u',n) as l, case when n <> 3 then concat('cloud-u',n) end as c
 from (select distinct doc_id % 17 as n from documents) where n < 16 and n <> 5
 union all
 select concat('p',n), concat('cloud-p',n) from (select distinct user_id % 23 as n from events) where n % 2 = 0)"""

FOUND = """found as (
 select owner as l from src union select grp from src
 union select e.name from src s join entries e on e.seq = s.seq where e.name is not null)"""


TREES = """tops as (select distinct source from documents), seconds as (select distinct source, lang from documents),
 newtop as (select source, concat('/', case source when 'src1' then 'src2' when 'src2' then 'src1' when 'src3' then 'src4'
   when 'src4' then 'src5' when 'src5' then 'src3' when 'src7' then 'src6' else source end) as path from tops),
 newsecond as (select s.source, lang, case when s.source = 'src9' and lang = 'en' then '/moved/en-of-9' else concat(t.path, '/',
   case when s.source <> 'src0' then lang when lang = 'en' then 'fr' when lang = 'fr' then 'de' when lang = 'de' then 'en' else lang end) end as path
   from seconds s join newtop t on t.source = s.source),
 old_ as (select concat('d:', source) as id, concat('/', source) as path, true as is_dir, 0 as length from tops
  union all select concat('d:', source, '/', lang), concat('/', source, '/', lang), true, 0 from seconds
  union all select concat('f:', doc_id), concat('/', source, '/', lang, '/', doc_id, '.txt'), false, n_chars from documents where doc_id % 9 <> 0),
 new_ as (select concat('d:', source) as id, path, true as is_dir, 0 as length from newtop where source not in ('src6', 'src8')
  union all select concat('d:', source, '/', lang), path, true, 0 from newsecond where source <> 'src6'
  union all select concat('n:', p), p, true, 0 from (values ('/moved'), ('/moved/files'), ('/rescued'), ('/src8')) v(p)
  union all select concat('f:', doc_id), case when d.source = 'src6' then concat('/rescued/', doc_id, '.txt')
    when doc_id % 10 = 3 then concat('/moved/files/', doc_id, '.txt') else concat(s.path, '/', doc_id, '.txt') end, false, n_chars
   from documents d join newsecond s on s.source = d.source and s.lang = d.lang
   where doc_id % 21 <> 0 and (d.source <> 'src6' or doc_id % 2 = 0)),
 both_ as (select coalesce(o.id, n.id) as id, o.path as was, n.path as now, o.is_dir as was_dir, n.is_dir as now_dir from old_ o full join new_ n on o.id = n.id),
 up as (select b.*, regexp_replace(was, '/[^/]*$', '') as dir, regexp_extract(was, '[^/]*$') as name from both_ b),
 carried as (select u.*, case when p.id is null then u.was else p.now || '/' || u.name end as carried from up u left join both_ p on p.was = u.dir and p.was_dir where u.was is not null),
 moves as (select was, now, concat('/.staging/', md5(was)) as aside from carried where now is distinct from carried),
 steps as (select 1 as phase, -(length(was) - length(replace(was, '/', ''))) as wave, 'STASH' as op, was as source, aside as target from moves
  union all select 2, 0, 'REMOVE', aside, null from moves where now is null
  union all select 2, length(now) - length(replace(now, '/', '')), 'MKDIR', null, now from both_ where was is null and now_dir
  union all select 2, length(now) - length(replace(now, '/', '')), 'PLACE', aside, now from moves where now is not null)"""


def triple(shift: int, perm: str = "perm") -> str:
    digits = " ".join(
        f"when {d} then '{'r' if d & 4 else '-'}{'w' if d & 2 else '-'}{'x' if d & 1 else '-'}'" for d in range(8)
    )
    return f"case ({perm} >> {shift}) & 7 {digits} end"


def full_acl(manifest: str, entries: str = "entries", key: str = "seq") -> str:
    """Long form (key, part, n, scope, type, name, perm) of the full entry list of each row."""
    has = f"exists (select 1 from {entries} e where e.seq = s.{key} and e.scope = 'access')"
    return f"""select s.{key} as k, 1 as part, 0 as n, 'access' as scope, 'user' as type, null as name, {triple(6, 's.perm')} as perm from {manifest} s
 union all select s.{key}, 2, e.n, e.scope, e.type, e.name, e.perm from {manifest} s join {entries} e on e.seq = s.{key} where e.scope = 'access'
 union all select s.{key}, 3, 0, 'access', case when {has} then 'mask' else 'group' end, null, {triple(3, 's.perm')} from {manifest} s
 union all select s.{key}, 4, 0, 'access', 'other', null, {triple(0, 's.perm')} from {manifest} s
 union all select s.{key}, 5, e.n, e.scope, e.type, e.name, e.perm from {manifest} s join {entries} e on e.seq = s.{key} where e.scope = 'default'"""


SOME_PARTS = f"""{SRC}, cut_ as (select path, seq, length, o, least(1000, length - o) as l from (select *, unnest(range(0, greatest(length, 1), 1000)) as o from src)),
 kept as (select path, seq, o, case when seq % 13 = 0 and o = 0 then l + 10 else l end as l from cut_
  where not (seq % 7 = 0 and o = 0 and length > 1500) and seq % 29 <> 0),
 parts as (select path, o, l, o + l as e from kept union all select path, o, l, o + l from kept where seq % 11 = 0 and o = 0)"""

CUSTOMERS = """counted as (
 select cast(n_nationkey as bigint) as box_id, n_name, (select count(*) from customer where c_nationkey = n_nationkey) as n,
  (select count(*) from customer) as n_all from nation)"""

DOCUMENT_BOXES = """select cast(r_regionkey as bigint) as box_id, r_name as dns,
  cast((select sum(n_chars) from documents) as bigint) // 20 * (r_regionkey + 1) as size_bytes from region"""
DOCUMENT_ROWS = "select doc_id as seq, n_chars as length from documents"

# A cast to integer rounds here but cuts off in Spark, hence trunc.
ORDER_ROWS = "select o_orderkey as seq, cast(trunc(o_totalprice) as bigint) as length from orders"
ORDER_BOXES = f"""select cast(r_regionkey as bigint) as box_id, case when r_regionkey < 4
  then (select cast(sum(length) as bigint) from ({ORDER_ROWS})) // 12 * (r_regionkey + 1) else 9223372036854775807 end as size_bytes from region"""


def placed(boxes: str = DOCUMENT_BOXES, rows: str = DOCUMENT_ROWS) -> str:
    """Sequential first fit: one step per row, the room of all boxes as a list."""
    return f"""boxes as ({boxes}),
 ranked as (select *, row_number() over (order by size_bytes, box_id) as pos from boxes),
 rows_ as materialized (select seq, length, row_number() over (order by seq) as rn from ({rows})),
 caps as (select list(size_bytes order by pos) as room, list(box_id order by pos) as ids from ranked),
 walk as (
  select cast(0 as bigint) as rn, cast(null as bigint) as seq, cast(null as bigint) as length, room, cast(0 as bigint) as hit from caps
  union all
  select r.rn, r.seq, r.length,
   case when h.hit = 0 then w.room else list_transform(w.room, lambda x, i: case when i = h.hit then x - r.length else x end) end,
   h.hit
  from walk w join rows_ r on r.rn = w.rn + 1,
   lateral (select coalesce(list_position(list_transform(w.room, lambda x: x >= r.length), true), 0) as hit) h),
 placed as (select w.seq, w.length, case when w.hit > 0 then c.ids[w.hit] end as box_id from walk w, caps c where w.rn > 0)"""


def balanced(n_splits: str, first_split: str, **source: str) -> str:
    """Sequential balancing: per box, splits as a list from most to least space, the one loaded last first among equals.

    ``n_splits`` and ``first_split`` of a box depend on its position ``pos``.
    """
    return f"""{placed(**source)},
 nums as materialized (select *, row_number() over (partition by box_id order by length desc, seq) as k from placed where box_id is not null),
 firsts as (select box_id, size_bytes, {n_splits} as n_splits, {first_split} as first_split from ranked),
 deal as (
  select box_id, cast(0 as bigint) as k, cast(null as bigint) as seq, cast(null as bigint) as length, cast(null as bigint) as split,
   list_transform(range(n_splits), lambda i: {{'s': i, 'u': cast(0 as bigint)}}) as loads
  from firsts
  union all
  select d.box_id, n.k, n.seq, n.length, d.loads[1].s,
   list_concat(
    list_concat(list_filter(d.loads[2:], lambda x: x.u < d.loads[1].u + n.length), [{{'s': d.loads[1].s, 'u': d.loads[1].u + n.length}}]),
    list_filter(d.loads[2:], lambda x: x.u >= d.loads[1].u + n.length))
  from deal d join nums n on n.box_id = d.box_id and n.k = d.k + 1),
 balanced as (select d.seq, d.length, d.box_id, f.first_split + d.split as split_id
  from deal d join firsts f on f.box_id = d.box_id where d.k > 0)"""


# Boxes below 100 TiB have factor 1: five boxes of six splits are scaled to 20 in all, hence four each. The
# unlimited box of the orders has factor 4, and 48 splits are scaled to 20: two each and ten.
PLACED = placed()
BALANCED = balanced("4", "(pos - 1) * 4")
BALANCED_ORDERS = balanced("case when pos < 5 then 2 else 10 end", "(pos - 1) * 2", boxes=ORDER_BOXES, rows=ORDER_ROWS)


def uniform(rows: str, n: int) -> str:
    """Sequential next fit over (seq, length) rows: one step per row."""
    return f"""rows_ as materialized (select *, row_number() over (order by seq) as rn from ({rows})),
 lim as (select cast(ceil(sum(length) / {n}) as bigint) as lim from rows_),
 walk as (
  select rn, seq, length, length as open_, cast(0 as bigint) as split_id from rows_ where rn = 1
  union all
  select r.rn, r.seq, r.length,
   case when w.open_ + r.length > l.lim then r.length else w.open_ + r.length end,
   case when w.open_ + r.length > l.lim then w.split_id + 1 else w.split_id end
  from walk w join rows_ r on r.rn = w.rn + 1, lim l)"""


OLD = f"""old_ as (
 select doc_id as file_id, case when doc_id % 10 = 3 then concat('/former',{NAME}) else {NAME} end as rel_path,
  case when doc_id % 8 = 0 then n_chars // 2 else n_chars end as length from documents where doc_id % 9 <> 0
 union all
 select -doc_id - 1, concat('/gone',{NAME}), n_chars from documents where doc_id % 21 = 0),
 new_ as (select doc_id as file_id, {NAME} as rel_path, n_chars as length from documents)"""


def diff(on: str) -> str:
    return f"""{OLD},
 both_ as (select o.rel_path as op, n.rel_path as np, o.length as ol, n.length as nl from old_ o full outer join new_ n on o.{on} = n.{on}),
 diff as (
  select 'CREATE' as change, cast(null as varchar) as source, np as target, nl as length from both_ where op is null
  union all select 'DELETE', op, null, null from both_ where np is null
  union all select 'RENAME', op, np, nl from both_ where op <> np
  union all select 'MODIFY', null, np, nl from both_ where ol <> nl)"""


def mode_action(mode: str) -> str:
    same = {
        "update": "t.length = s.length and coalesce(s.checksum = t.checksum, true)",
        "update_blocks": "t.length = s.length and s.block_size = t.block_size and coalesce(s.checksum = t.checksum, true)",
        "update_lengths": "t.length = s.length",
        "update_strict": "t.length = s.length and coalesce(s.checksum = t.checksum, false)",
        "plain": "true",
        "overwrite": "false",
    }[mode]
    return f"""select '{mode}' as mode, s.length, case when t.rel_path is not null and t.is_dir then 'CONFLICT'
 when t.rel_path is null then 'OVERWRITE' when {same} then 'SKIP' else 'OVERWRITE' end as action
 from src s left join tgt t on s.rel_path = t.rel_path"""


MODES = ("plain", "overwrite", "update", "update_blocks", "update_lengths", "update_strict")


def split_plan(factors: str, limit: int) -> str:
    factor = {
        "intended": "case when cap <= 109951162777600 then 1 else 4 end",
        "observed": "case when cap <= 48 then 4 when cap <= 224 then 1 else 4 end",
    }[factors]
    return f"""select '{factors}' as factors, cast({limit} as bigint) as max_splits, box_id, box_rank, n as n_splits,
  cast(sum(n) over (order by box_rank) - n as bigint) as first_split
 from (select *, cast(greatest(1, floor(6.0 * f * case when sum(6 * f) over () <= {limit} then 1.0
    else cast({limit} as double) / sum(6 * f) over () end)) as bigint) as n
  from (select *, {factor} as f, row_number() over (order by cap, box_id) - 1 as box_rank from caps))"""


TEXT_BYTES = "strlen(text)"

ORACLE: dict[str, str] = {
    "manifest_totals": f"""with {DIRS} select cast((select sum(n_chars) from documents) as bigint) as bytes,
 (select count(*) from documents) + (select count(*) from dirs) as paths, (select count(*) from dirs) as dirs""",
    "exclude_paths": f"""with {SRC} select path, length from src
 where not regexp_full_match(path, '.*/src1/.*') and not regexp_full_match(path, '/src/src2/e.*')
  and not regexp_full_match(path, '.*/1[0-9]*\\.txt') and not regexp_full_match(path, 'src.*')""",
    "exclude_keys": f"with {SRC} select path from src where seq not in (select doc_id from labels where toxic = 1)",
    "relative_paths": f"""with {DIRS}, tree as (
  select concat('/src', rel_path) as path, false as is_dir from (select {NAME} as rel_path from documents)
  union all select concat('/src', rel_path), true from dirs)
 select 'plain' as mode, path, substring(path, 5) as rel_path from tree
 union all
 select 'update', path, regexp_replace(path, '^/src/[^/]+', '') from tree where not regexp_full_match(path, '/src/[^/]+')""",
    "duplicate_targets": """select concat('/',lang,'/',doc_id % 50) as rel_path, count(*) as copies,
  min(concat('/src/',source,'/',lang,'/',doc_id,'.txt')) as first_path, max(concat('/src/',source,'/',lang,'/',doc_id,'.txt')) as last_path
 from documents group by 1 having count(*) > 1""",
    "union_manifests": """select '/src' as root, count(*) as paths, cast(sum(n_chars) as bigint) as bytes from documents
 union all select '/web', count(*), cast(sum(length(html)) as bigint) from pages
 union all select '/talk', count(*), cast(sum(length(text)) as bigint) from conversations""",
    "distinct_filesystems": "select distinct regexp_extract(url, '^([a-z]+://[^/]*)', 1) as file_system from pages",
    "qualified_paths": """select page_id, given, case when page_id % 2 = 1 then concat('https://default.example.org', given) else given end as qualified
 from (select page_id, case when page_id % 2 = 1 then regexp_replace(url, '^[a-z]+://[^/]*', '') else url end as given from pages)""",
    "match_globs": f"""with {SRC}
 select '/src/src1/*/*.txt' as glob, path from src where regexp_full_match(path, '/src/src1/[^/]*/[^/]*\\.txt')
 union all select '/src/src?/en/*[13579].txt', path from src where regexp_full_match(path, '/src/src[^/]/en/[^/]*[13579]\\.txt')
 union all select '/src/{{src0,src2}}/f?/*', path from src where regexp_full_match(path, '/src/(src0|src2)/f[^/]/[^/]*')
 union all select '/src/*/*/1?.txt', path from src where regexp_full_match(path, '/src/[^/]*/[^/]*/1[^/]\\.txt')""",
    "unmatched_globs": f"""with {SRC}
 select "glob" from (select * from (values ('/src/src1/*/*.txt', '/src/src1/[^/]*/[^/]*\\.txt'), ('/src/src?/en/*[13579].txt', '/src/src[^/]/en/[^/]*[13579]\\.txt'),
  ('/src/{{src0,src2}}/f?/*', '/src/(src0|src2)/f[^/]/[^/]*'), ('/src/*/*/1?.txt', '/src/[^/]*/[^/]*/1[^/]\\.txt'),
  ('/src/*/none/*', '/src/[^/]*/none/[^/]*'), ('/src/*', '/src/[^/]*')) g("glob", re)) g
 where not exists (select 1 from src where regexp_full_match(path, re))""",
    "match_many_globs": f"""with {SRC} select concat('/src/', d.source, '/', d.lang, '/', d.doc_id, '*.t?t') as glob, s.path from documents d
 join documents e on e.source = d.source and e.lang = d.lang and starts_with(cast(e.doc_id as varchar), cast(d.doc_id as varchar))
 join src s on s.seq = e.doc_id where d.doc_id % 5 = 0""",
    "exclude_many_filters": f"""with {SRC} select path from src where not regexp_full_match(path, '.*/[0-9]*[13]\\.txt') and not regexp_full_match(path, '.*/7[0-9]+\\.txt')""",
    "sort_manifest": f"with {SRC} select rel_path, length, row_number() over (order by rel_path) - 1 as idx from src",
    "randomize": f"with {SRC} select path, length, row_number() over (order by md5(concat('42:', path)), path) - 1 as seq from src",
    "list_tree": f"""with {DIRS} select {NAME} as rel_path, false as is_dir, {TEXT_BYTES} as length from documents
 union all select rel_path, true, 0 from dirs""",
    "list_file_sources": f"""with {DIRS} select {NAME} as rel_path, false as is_dir, {TEXT_BYTES} as length from documents
 union all select rel_path, true, 0 from dirs""",
    "manifest_defaults": f"""select doc_id as seq, {NAME} as path, doc_id % 10 = 0 as is_dir, n_chars as length,
  case when doc_id % 4 <> 0 then source else '' end as owner, case when doc_id % 6 <> 0 then lang else '' end as grp,
  cast(case when doc_id % 5 <> 0 then 384 when doc_id % 10 = 0 then 511 else 438 end as bigint) as perm, n_chars as chunk_length
 from documents""",
    "sync_actions": f"with {SYNC} select rel_path, action, length, tgt_length from sync",
    "sync_counters": f"""with {SYNC}
 select count(*) filter (action in ('APPEND','OVERWRITE')) as copy, cast(0 as bigint) as dir_copy,
  count(*) filter (action = 'SKIP') as skip, count(*) filter (action = 'CONFLICT') as fail,
  cast(sum(case action when 'APPEND' then length - tgt_length when 'OVERWRITE' then length else 0 end) as bigint) as bytes_copied,
  cast(sum(case when action in ('APPEND','OVERWRITE') then length else 0 end) as bigint) as bytes_expected,
  cast(sum(case when action = 'CONFLICT' then length else 0 end) as bigint) as bytes_failed,
  cast(sum(case when action = 'SKIP' then length else 0 end) as bigint) as bytes_skipped
 from sync""",
    "sync_modes": f"""with {SRC}, {TGT}, m as ({" union all ".join(mode_action(m) for m in MODES)})
 select mode, action, count(*) as files, cast(sum(length) as bigint) as bytes from m group by mode, action""",
    "append_candidates": f"""with {SRC}, {TGT}
 select s.rel_path, md5(substring(d.text, 1, cast(t.length as int))) as prefix_checksum
 from src s join tgt t on s.rel_path = t.rel_path join documents d on d.doc_id = s.seq
 where not t.is_dir and t.length < s.length""",
    "vanished_sources": f"with {SRC} select path from src where seq % 23 = 0",
    "verify_copy": f"""with {SRC}, {TGT}
 select s.rel_path, s.length, t.length as tgt_length, case when t.rel_path is null then 'MISSING' when t.is_dir then 'TYPE'
  when t.length <> s.length then 'LENGTH' when s.length <> 0 and s.checksum <> t.checksum then 'CHECKSUM' else 'OK' end as verdict
 from src s left join tgt t on s.rel_path = t.rel_path""",
    "extraneous_targets": f"with {SRC}, {TGT} select rel_path, length from tgt where rel_path not in (select rel_path from src)",
    "in_sync": f"""with {SRC}, {TGT}
 select rel_path, 'left' as only_in from src where rel_path not in (select rel_path from tgt)
 union all select rel_path, 'right' from tgt where rel_path not in (select rel_path from src)""",
    "snapshot_diff": f"with {diff('file_id')} select * from diff",
    "snapshot_diff_by_path": f"with {diff('rel_path')} select * from diff",
    "snapshot_replay": f"with {diff('file_id')} select * from diff where change in ('DELETE','RENAME')",
    "snapshot_copy_list": f"with {diff('file_id')} select target as rel_path, length from diff where change in ('CREATE','MODIFY')",
    "snapshot_replay_plan": f"with {TREES} select * from steps",
    "created_content": f"""with {TREES}, near as (
  select n.path, arg_max(s.op, length(s.target)) as op, arg_max(s.target, length(s.target)) as root
  from new_ n join steps s on s.op in ('MKDIR','PLACE') and (n.path = s.target or starts_with(n.path, s.target || '/')) group by n.path)
 select n.path as rel_path, n.is_dir, cast(n.length as bigint) as length, root from new_ n join near on near.path = n.path where near.op = 'MKDIR'""",
    "deletion_roots": f"""with {TREES}, kept as (select path from new_ where not (is_dir and path like '/src1%')),
 gone as (select * from old_ o where not exists (select 1 from kept k where k.path = o.path or starts_with(k.path, o.path || '/'))),
 root as (select g.path, coalesce(arg_min(d.path, length(d.path)), g.path) as root from gone g
  left join gone d on d.is_dir and (g.path = d.path or starts_with(g.path, d.path || '/')) group by g.path)
 select root as rel_path, bool_or(g.is_dir) filter (g.path = root) as is_dir, count(*) as entries, cast(sum(length) as bigint) as bytes
 from root r join gone g on g.path = r.path group by root""",
    "identities_distinct": f"with {SRC}, {ACL}, {FOUND} select l as local_identity from found",
    "identity_map_file": f"""with {SRC}, {ACL}, {FOUND}, {IDENTITIES}
 select f.l as local_identity, i.c as cloud_identity from found f left join idmap i on f.l = i.l""",
    "unmapped_identities": f"""with {SRC}, {ACL}, {FOUND}, {IDENTITIES}
 select l as local_identity from found where l not in (select l from idmap where c is not null)""",
    "identity_translation": f"""with {SRC}, {ACL}, {IDENTITIES},
 lists as (select e.seq, string_agg(concat(scope,':',type,':',coalesce(i.c, e.name, ''),':',perm), ',' order by n) as acl
  from entries e left join idmap i on i.l = e.name group by e.seq)
 select s.rel_path, coalesce(o.c, s.owner) as owner, coalesce(g.c, s.grp) as grp, coalesce(l.acl, '') as acl
 from src s left join idmap o on o.l = s.owner left join idmap g on g.l = s.grp left join lists l on l.seq = s.seq""",
    "logical_acl": f"""with {SRC}, {ACL}, full_ as ({full_acl("src")})
 select s.rel_path, row_number() over (partition by f.k order by f.part, f.n) - 1 as pos,
  concat(f.scope,':',f.type,':',coalesce(f.name,''),':',f.perm) as entry
 from full_ f join src s on s.seq = f.k""",
    "acl_transfer_plan": f"""with {SRC}, {TGT}, {ACL}, {IDENTITIES},
 sfull as ({full_acl("src")}),
 want as (select k, string_agg(concat(scope,':',type,':',coalesce(i.c, f.name, ''),':',perm), ',' order by part, n) as acl
  from sfull f left join idmap i on i.l = f.name group by k),
 held as (select * from entries where seq % 6 = 0),
 tnum as (select * from tgt where rel_path not like '/old/%'),
 tfull as ({full_acl("tnum", "held", "doc_id")}),
 have as (select k, string_agg(concat(scope,':',type,':',coalesce(name, ''),':',perm), ',' order by part, n) as acl from tfull group by k),
 plan as (select s.rel_path, coalesce(o.c, s.owner) as owner, coalesce(g.c, s.grp) as grp, w.acl,
   t.rel_path is null as missing, t.is_dir, h.acl as have, t.owner as towner, t.grp as tgrp
  from src s join want w on w.k = s.seq left join idmap o on o.l = s.owner left join idmap g on g.l = s.grp
  left join tnum t on t.rel_path = s.rel_path left join have h on h.k = t.doc_id)
 select rel_path, case when missing then 'MISSING' when is_dir then 'CONFLICT' else 'OK' end as status, owner, grp, acl,
  case when missing or is_dir then '' else concat_ws(',', case when acl <> have then 'acl' end,
   case when owner <> towner or grp <> tgrp then 'owner' end) end as setters
 from plan""",
    "acl_merged": f"""with {SRC}, {ACL}, full_ as ({full_acl("src")}),
 t as (select k, part, n, scope, type, case when name is not null then concat('team-', cast(substr(name, 2) as int) % 3) end as name, perm from full_),
 g as (select k, scope, type, name, min(cast(part as bigint) * 1000000000 + n) as pos, count(*) as c,
   bool_or(perm[1] = 'r') as r, bool_or(perm[2] = 'w') as w, bool_or(perm[3] = 'x') as x from t group by k, scope, type, name),
 m as (select k, scope, max(c) > 1 as joined, bool_or(r) filter (type = 'group' or (type = 'user' and name is not null)) as r,
   bool_or(w) filter (type = 'group' or (type = 'user' and name is not null)) as w,
   bool_or(x) filter (type = 'group' or (type = 'user' and name is not null)) as x from g group by k, scope),
 o as (select g.k, pos, g.scope, type, name, case when type = 'mask' and joined then coalesce(m.r, false) else g.r end as r,
   case when type = 'mask' and joined then coalesce(m.w, false) else g.w end as w,
   case when type = 'mask' and joined then coalesce(m.x, false) else g.x end as x from g join m on m.k = g.k and m.scope = g.scope)
 select s.rel_path, string_agg(concat(scope, ':', type, ':', coalesce(name, ''), ':', case when r then 'r' else '-' end, case when w then 'w' else '-' end,
  case when x then 'x' else '-' end), ',' order by pos) as acl from o join src s on s.seq = o.k group by s.rel_path""",
    "preserve_plan": f"""with {SRC}, {TGT}
 select s.rel_path, concat_ws(',', case when s.perm <> t.perm then 'permission' end,
  case when s.replication <> t.replication and not t.is_dir then 'replication' end,
  case when s.owner <> t.owner or s.grp <> t.grp then 'owner' end, 'times') as setters
 from src s join tgt t on s.rel_path = t.rel_path""",
    "xattr_filter": f"""with x as (
  select {NAME} as rel_path, 'user.lang' as name, lang as value from documents
  union all select {NAME}, 'trusted.source', case when doc_id % 6 <> 0 then source end from documents
  union all select {NAME}, 'raw.chars', cast(n_chars as varchar) from documents)
 select 'raw' as mode, * from x where name like 'raw%' union all select 'regular', * from x where name not like 'raw%'
 union all select 'both', * from x""",
    "xattr_plan": f"""select {NAME} as rel_path, case when doc_id % 4 = 0 and lang <> 'xx' then 'xattr' else '' end as setters from documents""",
    "attribute_sets": """select doc_id, concat(case when doc_id % 2 = 0 then 'times' else 'permission' end, ',',
   case when doc_id % 3 = 0 then 'replication' else 'blocksize' end, ',', case when doc_id % 5 = 0 then 'acl' else 'user' end,
   case when doc_id % 2 = 0 then ',permission' else '' end) as names,
  concat(case when doc_id % 3 = 0 then 'R' else 'B' end, case when doc_id % 5 = 0 then '' else 'U' end, 'P',
   case when doc_id % 5 = 0 then 'A' else '' end, case when doc_id % 2 = 0 then 'T' else '' end) as packed
 from documents""",
    "boxes_config": f"""with {CUSTOMERS} select box_id, n_name as dns, case when box_id % 3 = 0 then 'own' else 'shared' end as container,
  case when box_id % 4 <> 0 then n * 1000 end as size_bytes,
  case when box_id % 2 = 0 then concat('wasb://', case when box_id % 3 = 0 then 'own' else 'shared' end, '@', n_name, '/') else n_name end as target_uri
 from counted""",
    "plan_splits": f"""with {CUSTOMERS}, caps as (select box_id,
  case when box_id = 7 then 9223372036854775807 else n * 25000 // n_all * 109951162777 end as cap from counted)
 {split_plan("intended", 20)} union all {split_plan("intended", 1000)} union all {split_plan("observed", 100)}""",
    "create_attributes": f"""with {SRC} select l as letters, rel_path, case when l = 'rb' then replication else 2 end as want_replication,
  cast(case when l = 'u' then 1048576 else block_size end as bigint) as want_block_size from src, (values ('u'), ('rb'), ('c')) t(l)""",
    "first_fit_placement": f"with recursive {PLACED} select seq, length, box_id from placed",
    "skipped_files": f"""with recursive {PLACED}
 select concat('/src',{NAME},' - cannot locate on any target box') as line from placed p join documents d on d.doc_id = p.seq where box_id is null""",
    "balance_lpt": f"with recursive {BALANCED} select seq, box_id, split_id from balanced",
    "placement_report": f"""with recursive {BALANCED},
 each_ as (select f.box_id, f.first_split + i as split_id, f.size_bytes, f.size_bytes // 4 as share from firsts f, range(4) t(i)),
 per as (select e.box_id, e.split_id, e.share, e.size_bytes, count(b.seq) as records, coalesce(sum(b.length), 0) as bytes
  from each_ e left join balanced b on b.split_id = e.split_id group by all)
 select box_id, split_id, records, cast(bytes as bigint) as bytes, cast(share - bytes as bigint) as space_left from per
 union all select box_id, null, cast(sum(records) as bigint), cast(sum(bytes) as bigint), cast(any_value(size_bytes) - sum(bytes) as bigint) from per group by box_id
 union all select null, null, cast(sum(records) as bigint), cast(sum(bytes) as bigint), cast((select sum(size_bytes) from boxes) - sum(bytes) as bigint) from per""",
    "target_uris": f"""with recursive {PLACED}
 select p.seq, concat(case when p.box_id % 2 = 0 then concat('wasb://files@', b.dns) else b.dns end, {NAME}) as target_uri
 from placed p join boxes b on b.box_id = p.box_id join documents d on d.doc_id = p.seq""",
    "placement_orders": f"with recursive {BALANCED_ORDERS} select seq, length, box_id, split_id from balanced",
    "uniform_split_orders": f"""with recursive {uniform(ORDER_ROWS, 50)}
 select split_id, count(*) as records, cast(sum(length) as bigint) as bytes, min(seq) as first_seq from walk group by split_id""",
    "uniform_split": f"""with recursive {uniform("select doc_id as seq, n_chars as length from documents", 20)}
 select w.seq, {NAME} as rel_path, w.split_id from walk w join documents d on d.doc_id = w.seq""",
    "deal_chunks": f"""with n as (select count(*) as n from documents),
 r as (select n, case when ceil(n / (7.0 * 15)) < 5 then 2 else 15 end as ratio from n),
 e as (select n, cast(ceil(n / (ratio * 7.0)) as bigint) as e from r),
 c as (select e, cast(ceil(n / cast(e as double)) as bigint) as c from e),
 b as (select e, c, greatest(0, c // 16 - 1) as nb from c),
 i as (select {NAME} as rel_path, row_number() over (order by doc_id) - 1 as idx from documents)
 select rel_path, idx, case when idx < nb * 16 * e then idx // (16 * e) * 16 + (idx % (16 * e)) % 16
  else 16 * nb + (idx - nb * 16 * e) % (c - 16 * nb) end as chunk_id from i, b""",
    "chunk_files": f"""with {SRC} select concat(path, '.____split____', o, '.', least(1000, length - o)) as part, o as chunk_offset, least(1000, length - o) as bytes
 from (select path, length, unnest(range(0, greatest(length, 1), 1000)) as o from src)""",
    "part_coverage": f"""with {SOME_PARTS},
 w as (select *, coalesce(max(e) over (partition by path order by o, l rows between unbounded preceding and 1 preceding), 0) as upto,
   coalesce(lag(o) over (partition by path order by o, l) = o and lag(l) over (partition by path order by o, l) = l, false) as again from parts),
 g as (select path, count(*) as parts, max(e) as last, min(o) filter (again and l > 0) as rep, min(o) filter (not again and o < upto) as over_, min(upto) filter (o > upto) as gap from w group by path)
 select s.path, case when parts is null then 'MISSING' when rep is not null then 'REPEATED' when over_ is not null then 'OVERLAP'
   when gap is not null or last < length then 'GAP' when last > length then 'BEYOND' else 'OK' end as verdict,
  case when parts is null then 0 when rep is not null then rep when over_ is not null then over_ when gap is not null then gap
   when last < length then last when last > length then length end as "at", coalesce(parts, 0) as parts from src s left join g on g.path = s.path""",
    "merged_ranges": f"""with {SOME_PARTS},
 w as (select *, coalesce(o > max(e) over (partition by path order by o, e rows between unbounded preceding and 1 preceding), true) as fresh from parts),
 r as (select *, sum(cast(fresh as int)) over (partition by path order by o, e rows unbounded preceding) as k from w)
 select path, min(o) as first_byte, max(e) as end_byte, count(*) as parts from r group by path, k""",
    "human_bytes": """with s as (select doc_id, n_chars * cast(pow(1024, doc_id % 5) as bigint) as b from documents),
 p as (select doc_id, b, case when b >= 1125899906842624 then 5 when b >= 1099511627776 then 4 when b >= 1073741824 then 3
  when b >= 1048576 then 2 when b >= 1024 then 1 else 0 end as k from s)
 select doc_id, concat(printf('%.1f', round_even(b / pow(1024, k), 1)), substring('BKMGTP', k + 1, 1)) as size from p""",
    "copy_progress": f"""with {SRC}, {TGT}
 select s.rel_path, cast(round(round_even(coalesce(t.length, 0) * 100.0 / nullif(s.length, 0), 1) * 10) as bigint) as per_mille
 from src s left join tgt t on s.rel_path = t.rel_path""",
    "action_log": f"""with {SYNC}, sized as (
  select *, concat('source=', path, ', size=', length, ' --> target=file:/box', rel_path, ', size=', coalesce(tgt_length, 0)) as t from sync)
 select rel_path, action, concat('SKIP: ', path) as line from sized where action = 'SKIP'
 union all select rel_path, action, concat('FILE_SKIPPED: ', t) from sized where action = 'SKIP'
 union all select rel_path, action, concat('FILE_COPIED: ', t) from sized where action in ('APPEND','OVERWRITE')
 union all select rel_path, action, concat('FAIL: ', path, ' - type differs') from sized where action = 'CONFLICT'""",
    "throughput_report": """with g as (select doc_id % 7 as split_id, cast(sum(n_chars) as bigint) as bytes,
   max(doc_id * 1000 + n_chars) - min(doc_id * 1000) as elapsed_ms from documents group by 1)
 select *, case when elapsed_ms // 1000 = 0 then bytes else bytes // (elapsed_ms // 1000) end as bytes_per_sec from g""",
    "copy_files": f"""with {DIRS} select {NAME} as rel_path, 'OVERWRITE' as action, 'OK' as status, {TEXT_BYTES} as bytes_copied, md5(text) as checksum from documents
 union all select rel_path, 'MKDIR', 'OK', 0, null from dirs""",
    "copy_counters": f"""with {DIRS} select (select count(*) from documents) as copy, (select count(*) from dirs) as dir_copy,
  cast(0 as bigint) as skip, cast(0 as bigint) as fail, (select cast(sum({TEXT_BYTES}) as bigint) from documents) as bytes_copied,
  (select cast(sum({TEXT_BYTES}) as bigint) from documents) as bytes_expected, cast(0 as bigint) as bytes_failed, cast(0 as bigint) as bytes_skipped""",
    "predicate_filter": f"""with {SRC} select 'none' as mode, path from src union all select 'small', path from src where length >= 500
 union all select 'unknown', path from src where seq % 3 = 0 or owner <> 'u4'""",
    "checked_roots": """select distinct concat('source=', source) as name, true as is_dir, cast(null as varchar) as error from documents
 union all select distinct concat('source=', source, '/lang=', lang), true, null from documents
 union all select distinct concat('lang=', lang), false, 'not found' from documents""",
    "named_splits": f"""with {SRC} select concat('chunk-', lpad(cast(seq % 250 as varchar), 5, '0')) as name, max(mtime + length) // 1000 as changed from src group by 1""",
    "copy_outcomes": f"""with g as (select source, lang, cast(sum(coalesce({TEXT_BYTES}, 0) + 1) as bigint) as bytes from documents group by source, lang)
 select source, lang, case when lang = 'de' then 'SKIP' when lang = 'fr' then 'APPEND' when lang = 'es' and source = 'src4' then 'CONFLICT' else 'OVERWRITE' end as action,
  case when (lang = 'es' and source = 'src4') or (lang = 'en' and source = 'src1') then 'FAIL' else 'OK' end as status,
  case when lang = 'es' and source = 'src4' then 'conflict' when lang = 'en' and source = 'src1' then 'read' end as error_class,
  cast(case when lang = 'de' or (lang = 'es' and source = 'src4') then 0 when lang = 'en' and source = 'src1' then 3 else 1 end as bigint) as attempts, bytes,
  case when (lang = 'es' and source = 'src4') or (lang = 'en' and source = 'src1') then 0 else bytes end as bytes_there
 from g""",
}

ORACLE["strategy_splits"] = f"""select 'first_fit' as strategy, d.doc_id as seq, b.split_id from documents d left join ({ORACLE["balance_lpt"]}) b on b.seq = d.doc_id
 union all select 'uniform', seq, split_id from ({ORACLE["uniform_split"]})
 union all select 'dynamic', d.doc_id, c.chunk_id from ({ORACLE["deal_chunks"]}) c join documents d on c.rel_path = {NAME}"""
