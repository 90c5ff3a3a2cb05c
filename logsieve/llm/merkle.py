"""Merkle manifest of a table, with a proof for every row by pointer jumping.

A row is a leaf: the SHA-256 of its fields. The leaves of a group, in ascending order, form a tree in which every
ARITY consecutive nodes (the last run: fewer, even one) have their hash as parent, until one node remains; the
groups' subroots, in order of the groups, form one more such tree, whose root stands for the whole table.

Places in the order come from one range shuffle and sums per partition and group. Trees are built CHUNK levels at a
time, from runs of ARITY^CHUNK leaves, so no task meets a whole group. Each node but a root then holds a segment: for
every step towards an ancestor its place in the run and the siblings' digests. At first all segments reach the
parent. A self-join appends to each segment that of the ancestor it reaches, which doubles the distance, until every
leaf's reaches its subroot and, through the subroot's own segment, the root. At distance d only nodes at levels that
are multiples of 2 d go on, and meet nodes at odd multiples of d: these are few where many leaves share one, so a join
either broadcasts at most BROADCAST_ROWS of them or has keys with at most about 4 / BROADCAST_ROWS of the rows each.

Defined cases: a null field is `-` in a leaf; null orders and groups come first; leaves of equal group and order
follow each other by digest, equal ones in any order, which changes no digest; a group of one leaf has that leaf as
subroot; an empty table gives no rows. Columns that aren't fields, group or order are not looked at.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .blocks import written
from .skew import spread_join

ARITY = 3
#: Levels that a task builds at a time: chunks of 3^5 nodes.
CHUNK = 5
BROADCAST_ROWS = 1 << 14
OUT_ROWS = 8192
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def field(c: Column) -> Column:
    """`-` if null, else the UTF-8 byte count, a colon and the value."""
    text = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(columns: list[Column]) -> Column:
    """The digest (32 bytes) of a row's fields."""
    return F.unhex(F.sha2(F.concat(*[field(c) for c in columns]), 256))


def _hash(digests: list[str]) -> str:
    return hashlib.sha256("".join(digests).encode()).hexdigest()


# ------------------------------------------------------------------ places

def _numbered(tree: int, names: list[str]):
    def run(batches):
        last, n = None, 0
        for batch in batches:
            at = []
            for t in batch.column(tree).to_pylist():
                n = n + 1 if t == last else 0
                last = t
                at.append(n)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(at, pa.int64())], names=names)
    return run


def placed(rows: DataFrame, order: list[Column]) -> DataFrame:
    """rows (tree, ...) with idx, the place in its tree by `order`, and n, the rows of the tree. Give a written table."""
    ordered = (rows.repartitionByRange(F.col("tree"), *order).withColumn("part", F.spark_partition_id())
               .sortWithinPartitions("tree", *order))
    schema = T.StructType([*ordered.schema.fields, T.StructField("at", T.LongType())])
    ordered = written(ordered.mapInArrow(_numbered(ordered.columns.index("tree"), schema.names), schema), "ordered")
    # a row for each partition and each tree in it: partitions + trees at most
    sums = ordered.groupBy("tree", "part").agg(F.count(F.lit(1)).alias("c"))
    before = Window.partitionBy("tree").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("tree", "part", F.coalesce(F.sum("c").over(before), F.lit(0)).cast("long").alias("base"),
                       F.sum("c").over(Window.partitionBy("tree")).cast("long").alias("n"))
    return (ordered.join(sums, ["tree", "part"]).withColumn("idx", F.col("base") + F.col("at")).drop("part", "at", "base"))


# ------------------------------------------------------------------ trees

def _build(level: int, carried: list[T.StructField], schema: pa.Schema):
    """Sorted chunks of a level's nodes -> segments to the parent of all nodes below the chunk's top, and the top."""
    def subtree(rows, out):
        tree, chunk, n = rows[0]["tree"], rows[0]["chunk"], rows[0]["n"]
        width, k = -(-n // ARITY**level), level
        nodes, first, extra = [r["digest"].hex() for r in rows], rows[0]["idx"], rows
        if level == 0 and width == 1:
            out.append({"tree": tree, "level": 0, "idx": 0, "path": b"", "sibs": b""} | {c.name: rows[0][c.name] for c in carried})
        while width > 1 and k < level + CHUNK:
            above = []
            for i in range(0, len(nodes), ARITY):
                run = nodes[i : i + ARITY]
                for p in range(len(run)):
                    row = {"tree": tree, "level": k, "idx": first + i + p, "path": bytes([p * 16 + len(run)]),
                           "sibs": bytes.fromhex("".join(run[:p] + run[p + 1 :]))}
                    out.append(row | {c.name: extra[i + p][c.name] for c in carried} if k == 0 else row)
                above.append(_hash(run))
            nodes, first, width, k = above, first // ARITY, -(-width // ARITY), k + 1
        # one node is left: the chunk's top, or the tree's root
        out.append({"tree": tree, "level": k, "idx": first, "top": bytes.fromhex(nodes[0]), "n": n})

    def run(batches):
        held, key, out = [], None, []
        for batch in batches:
            for r in batch.to_pylist():
                if key != (r["tree"], r["chunk"]):
                    if held:
                        subtree(held, out)
                    held, key = [], (r["tree"], r["chunk"])
                    if len(out) >= OUT_ROWS:
                        yield pa.RecordBatch.from_pylist(out, schema=schema)
                        out = []
                held.append(r)
        if held:
            subtree(held, out)
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=schema)
    return run


def trees(rows: DataFrame, carry: list[str]) -> tuple[DataFrame, DataFrame, int]:
    """(segments, roots, height) of rows (tree, idx, n, digest and the columns to carry), a written table.

    segments: tree, level, idx, path, sibs of each node but the roots, reaching its parent (a lone leaf: itself);
    leaves carry columns along. path has a byte a step, 16 * place + nodes of the run. roots: tree, digest.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    carried = [rows.schema[c] for c in carry]
    base = T.StructType([T.StructField("tree", T.StringType()), T.StructField("level", T.IntegerType()), T.StructField("idx", T.LongType()),
                         T.StructField("path", T.BinaryType()), T.StructField("sibs", T.BinaryType())])
    schema = T.StructType([*base.fields, T.StructField("top", T.BinaryType()), T.StructField("n", T.LongType()), *carried])
    largest, height = rows.agg(F.max("n")).first()[0] or 0, 0
    while ARITY**height < largest:
        height += 1
    built, nodes = [], rows
    for level in range(0, max(height, 1), CHUNK):
        chunks = (nodes.withColumn("chunk", F.expr(f"idx div {ARITY**CHUNK}")).repartition("tree", "chunk")
                  .sortWithinPartitions("tree", "chunk", "idx"))
        made = written(chunks.mapInArrow(_build(level, carried if level == 0 else [], to_arrow_schema(schema)), schema), "trees")
        built.append(made)
        nodes = made.where(F.col("top").isNotNull() & (F.col("n") > F.lit(ARITY ** (level + CHUNK)))).select(
            "tree", "idx", "n", F.col("top").alias("digest"))
    every = built[0]
    for more in built[1:]:
        every = every.unionByName(more)
    # a top whose level is the height of its own tree is the root
    roots = every.where(F.col("top").isNotNull() & (F.col("n") <= F.pow(F.lit(ARITY), F.col("level")).cast("long")))
    links = every.where(F.col("top").isNull()).drop("top", "n")
    return links, roots.select("tree", F.col("top").alias("digest")), height


def proofs(links: DataFrame, height: int, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Pointer jumping: the segments of the leaves, reaching their tree's root, with the columns they carry."""
    d = 1
    while d < height:
        here = links.where(F.col("level") % (2 * d) == 0)
        there = links.where(F.col("level") % (2 * d) == d).select(
            F.col("tree").alias("_tree"), F.col("level").alias("_level"), F.col("idx").alias("_idx"),
            F.col("path").alias("_path"), F.col("sibs").alias("_sibs"))
        if there.count() <= broadcast_rows:
            there = F.broadcast(there)
        same = ((F.col("tree") == F.col("_tree")) & (F.col("level") + d == F.col("_level"))
                & (F.expr(f"idx div {ARITY**d}") == F.col("_idx")))
        longer = here.join(there, same, "left")
        for c in ("path", "sibs"):
            longer = longer.withColumn(c, F.concat(c, F.coalesce(f"_{c}", F.lit(b""))))
        links = written(longer.drop("_tree", "_level", "_idx", "_path", "_sibs"), "segments")
        d *= 2
    return links.where("level = 0").drop("level")


# ------------------------------------------------------------------ manifest

def fold(digest: str, path: bytes, sibs: bytes) -> str:
    """The root that a leaf's digest (hex) gives with the siblings of a segment."""
    at = 0
    for step in path:
        place, size = step >> 4, step & 15
        run = [sibs[at + 32 * i : at + 32 * i + 32].hex() for i in range(size - 1)]
        digest = _hash([*run[:place], digest, *run[place:]])
        at += 32 * (size - 1)
    return digest


def manifest(docs: DataFrame, fields=FIELDS, group: str = "source", order: str = "doc_id", changed: Column | None = None) -> DataFrame:
    """A row for each row of docs: its order column, `leaf`, `seen` (the digest with the changed text, if any), `path`
    and `sibs` (its proof up to the root), `subroot` and `root`; digests are binary.

    changed: the `text` to look at again for `seen`, null where the row is as it was.
    """
    columns = [docs[c] for c in fields]
    seen = F.lit(None).cast("binary")
    if changed is not None:
        seen = F.when(changed.isNotNull(), leaf([changed if c == "text" else docs[c] for c in fields]))
    # null groups before all others
    tree = F.coalesce(F.concat(F.lit("s"), docs[group].cast("string")), F.lit("-"))
    rows = written(docs.select(tree.alias("tree"), docs[order].alias("place"), leaf(columns).alias("digest"), seen.alias("seen"))
                   .withColumn("uid", F.monotonically_increasing_id()), "leaves")
    rows = placed(rows, [F.col("place").asc_nulls_first(), F.col("digest"), F.col("uid")]).drop("uid")
    rows = written(rows.withColumn("leaf", F.col("digest")), "placed")
    links, subroots, height = trees(rows, ["place", "leaf", "seen"])
    low = written(proofs(links, height), "proofs")

    tops = placed(written(subroots.select(F.lit("").alias("tree"), F.col("tree").alias("member"), F.col("digest")), "subroots"), [F.col("member")])
    tops = written(tops.withColumn("subroot", F.col("digest")), "tops")
    links, root, height = trees(tops, ["member", "subroot"])
    root = F.broadcast(root.select(F.col("tree").alias("_t"), F.col("digest").alias("root")))  # one row
    high = proofs(links, height).join(root, F.col("tree") == F.col("_t")).select(
        F.col("member").alias("tree"), "subroot", "root", F.col("path").alias("up"), F.col("sibs").alias("up_sibs"))
    out = spread_join(low, written(high, "high"), ["tree"])
    return out.select(F.col("place").alias(order), "leaf", "seen", F.concat("path", "up").alias("path"),
                      F.concat("sibs", "up_sibs").alias("sibs"), "subroot", "root")


def _checked(batches):
    for batch in batches:
        col = {c: batch.column(c).to_pylist() for c in ("leaf", "seen", "path", "sibs", "subroot", "root")}
        text = {c: [x.hex() for x in col[c]] for c in ("leaf", "subroot", "root", "sibs")}
        folded = [fold((s or x).hex(), p, b) for s, x, p, b in zip(col["seen"], col["leaf"], col["path"], col["sibs"])]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(text["leaf"]), pa.array(text["subroot"]), pa.array(text["root"]),
             pa.array([_hash([s]) for s in text["sibs"]], pa.string()), pa.array(folded, pa.string()),
             pa.array([a == b for a, b in zip(folded, text["root"])], pa.bool_())],
            names=["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"])


def verified(proven: DataFrame) -> DataFrame:
    """A manifest's rows (doc_id first), each folded from the leaf as seen and its proof, with whether that gives the root."""
    return proven.mapInArrow(_checked, "doc_id long, leaf string, subroot string, root string, proof_sha256 string, "
                                       "folded_root string, verified boolean")


def tampered(doc_id: Column, text: Column) -> Column:
    """The text without its line feeds, for rows whose decimal doc_id has an even CRC-32; null where nothing changes."""
    even = F.crc32(doc_id.cast("string").cast("binary")) % 2 == 0
    return F.when(even & F.contains(text, F.lit("\n")), F.replace(text, F.lit("\n"), F.lit("")))


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *FIELDS[1:])
    return verified(manifest(docs, changed=tampered(F.col("doc_id"), F.col("text"))))


#: Levels that the SQL states for each of the two trees: enough for 3^13 rows of a source and as many sources.
_LEVELS = 13


def _crc32_sql(text: str) -> str:
    """CRC-32 of an ASCII text in DuckDB, with a table made by the rule."""
    return f"""xor(list_reduce(list_prepend(4294967295::bigint, list_transform(string_split({text}, ''), lambda c: ascii(c)::bigint)),
        lambda crc, b: xor(crc >> 8, crc_table.t[(xor(crc, b) & 255) + 1])), 4294967295::bigint)"""


def _tree_sql(name: str, first: str) -> str:
    """Levels name_0.. of (tree, idx, h, n), their runs, and for each leaf the proof and the folded digest."""
    out = [f"{name}_0 as materialized ({first})"]
    for k in range(_LEVELS):
        out.append(f"{name}_r{k} as materialized (select tree, idx // 3 as idx, n, list(h order by idx) as hs from {name}_{k} group by tree, idx // 3, n)")
        out.append(f"""{name}_{k + 1} as materialized (select tree, idx, case when n > 1 then sha256(array_to_string(hs, '')) else hs[1] end as h,
            (n + 2) // 3 as n from {name}_r{k})""")
    return ",\n".join(out)


def _fold_sql(name: str, tree: str, first: str) -> str:
    """Rows (..., tree, pos, cur, proof) taken up the levels of a tree, as name_<levels>."""
    out = [f"{name}_0 as materialized ({first})"]
    for k in range(_LEVELS):
        own = f"(f.pos // {3**k}) % 3 + 1"
        out.append(f"""{name}_{k + 1} as materialized (select f.* exclude (cur, proof),
            case when r.n > 1 then sha256(array_to_string(list_transform(r.hs, lambda x, i: case when i = {own} then f.cur else x end), '')) else f.cur end as cur,
            case when r.n > 1 then f.proof || array_to_string(list_filter(r.hs, lambda x, i: i <> {own}), '') else f.proof end as proof
            from {name}_{k} f join {tree}_r{k} r on r.tree = f.tree and r.idx = f.pos // {3 ** (k + 1)})""")
    return ",\n".join(out)


def _field_sql(c: str) -> str:
    return f"coalesce(strlen({c}::varchar)::varchar || ':' || {c}::varchar, '-')"


ORACLE = f"""
with crc_table as (select list_transform(range(256), lambda v: list_reduce(list_prepend(v::bigint, list_transform(range(8), lambda i: 0::bigint)),
    lambda c, i: case when c & 1 = 1 then xor(c >> 1, 3988292384::bigint) else c >> 1 end)) as t),
d as (select doc_id, coalesce('s' || source, '-') as tree,
    sha256({' || '.join(_field_sql(c) for c in FIELDS)}) as leaf,
    sha256({' || '.join(_field_sql(c) for c in FIELDS[:-1])} || {_field_sql("case when " + _crc32_sql('doc_id::varchar') + " % 2 = 0 then replace(text, chr(10), '') else text end")}) as seen
    from documents, crc_table),
l as materialized (select *, row_number() over (partition by tree order by doc_id nulls first, leaf) - 1 as pos, count(*) over (partition by tree) as n from d),
{_tree_sql('a', 'select tree, pos as idx, leaf as h, n from l')},
s as materialized (select tree as member, h as subroot, row_number() over (order by tree) - 1 as up, count(*) over () as n from a_{_LEVELS}),
{_tree_sql('b', "select '' as tree, up as idx, subroot as h, n from s")},
{_fold_sql('e', 'a', "select doc_id, leaf, tree, pos, seen as cur, '' as proof from l")},
{_fold_sql('f', 'b', f"select doc_id, leaf, subroot, '' as tree, up as pos, cur, proof from e_{_LEVELS} e join s on s.member = e.tree")}
select f.doc_id, f.leaf, f.subroot, b.h as root, sha256(f.proof) as proof_sha256, f.cur as folded_root, f.cur = b.h as verified
from f_{_LEVELS} f join b_{_LEVELS} b on true
"""
