"""A Merkle manifest of a dataset, and the proof of every row checked by a recursive climb.

Each row is a leaf: the SHA-256 of its columns, each as ``-`` (null) or as its UTF-8 byte count, ``:``
and its value.  Per source, leaves in order of ``doc_id`` form a tree of runs of ``FANOUT`` nodes (the
last run may hold fewer, even one); what remains is the source's root, and the source roots, in order
of the source, form the dataset's tree in the same way.

1. Order.  Leaf rows, free of texts, are range-partitioned by (source, doc_id, leaf); a row's place is its
   place in its partition plus the rows of its source in earlier ones, so no source meets in one task.
2. Build.  ``LEVELS`` levels are built at once from blocks of ``FANOUT ** LEVELS`` neighbours and stored as
   node rows: a node's digest, its siblings up to the block's root, and the link to that root's row.
3. Climb.  A Spark recursive query starts at every leaf, with the hash of its possibly tampered row, and
   ascends by the links: each step folds the hash with the siblings of a stored node and adds a row
   with these siblings.  The rows of a leaf, in order, are its proof; the last hash must be the root.
   Rows of a step don't carry those before, so the climb's size grows with leaves times height.

Defined results: a null id or source comes first; a row with a null id is not tampered with; repeated
rows are leaves of their own (equal leaves are interchangeable, so their order doesn't matter); a lone
leaf is its source's root, a lone source's root is the root, and a proof without siblings is the hash of
nothing; further columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import fold, written

FANOUT = 3
LEVELS = 3  # levels that one node row spans
BLOCK = FANOUT**LEVELS
TOP = -1  # the group of the tree over sources
COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]
NODE = "grp bigint, level int, pos bigint"
# Siblings stand in front of and behind the hash that is being folded.
CLIMB = """
WITH RECURSIVE climb(leaf_id, step, hash, siblings, subroot, grp, level, pos) AS (
  SELECT leaf_id, 0, folded, siblings, CAST(NULL AS BINARY), up_grp, up_level, up_pos FROM {leaves}
  UNION ALL
  SELECT c.leaf_id, c.step + 1,
    aggregate(n.around, c.hash, (hash, s) -> unhex(sha2(lower(hex(concat(s.before, hash, s.after))), 256))),
    aggregate(n.around, X'', (all, s) -> concat(all, s.before, s.after)),
    n.subroot, n.up_grp, n.up_level, n.up_pos
  FROM climb c JOIN {nodes} n ON c.grp = n.grp AND c.level = n.level AND c.pos = n.pos
)
SELECT leaf_id, step, hash, siblings, subroot FROM climb LIMIT ALL
"""


def leaf_hash(*values: Column) -> Column:
    """The digest of a row's values."""
    fields = [F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(value), F.lit(":"), value)) for value in values]
    return F.unhex(F.sha2(F.concat(*fields).cast("binary"), 256))


def text_hash(digests: Column) -> Column:
    """The digest, as text, of an array of digests as text."""
    return F.sha2(F.array_join(digests, "").cast("binary"), 256)


def runs_above(digests: Column) -> Column:
    """The digests one level up."""
    last = F.floor((F.size(digests) - 1) / FANOUT)
    return F.transform(F.sequence(F.lit(0).cast("bigint"), last), lambda i: text_hash(F.slice(digests, (i * FANOUT + 1).cast("int"), F.lit(FANOUT))))


def leaf_rows(docs: DataFrame) -> DataFrame:
    """(source, doc_id, leaf, tampered) of each row: its digest, and that of the tampered row."""
    values = {name: F.col(name).cast("string") for name in COLUMNS}
    bare = F.when(F.coalesce(fold("doc_id", 2) == 0, F.lit(False)), F.replace(values["text"], F.lit("\n"), F.lit(""))).otherwise(values["text"])
    kept = [values[name] for name in COLUMNS[:-1]]
    return docs.select(
        values["source"].alias("source"),
        F.col("doc_id").cast("bigint").alias("doc_id"),
        leaf_hash(*kept, values["text"]).alias("leaf"),
        leaf_hash(*kept, bare).alias("tampered"),
    )


def placed(rows: DataFrame, group: str, order: list[str]) -> tuple[DataFrame, DataFrame]:
    """Rows in order with a number ``at`` of their own, and where each group's rows of a partition begin.

    The second table (group, part, first, before) is small: a row for each partition, and one for each group.
    """
    dealt = rows.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
    # The number is the partition, and below it the place in the partition.
    numbered = written(dealt.withColumn("at", F.monotonically_increasing_id()))
    parts = numbered.groupBy(group, F.shiftright("at", 33).alias("part")).agg(F.min("at").alias("first"), F.count("*").alias("rows"))
    earlier = Window.partitionBy(group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return numbered, parts.withColumn("before", F.coalesce(F.sum("rows").over(earlier), F.lit(0))).drop("rows")


def ordered_leaves(docs: DataFrame) -> DataFrame:
    """(grp, n, pos, digest, tampered, leaf_id, doc_id): the source's place, its leaves, and each leaf's place among them."""
    rows = written(leaf_rows(docs)).withColumn("copy", F.monotonically_increasing_id())
    numbered, parts = placed(rows, "source", ["doc_id", "leaf", "copy"])
    sizes = numbered.groupBy("source").agg(F.count("*").alias("n")).withColumn("all", F.lit(0))
    sources, starts = placed(sizes, "all", ["source"])
    begun = starts.select("part", "first", "before")
    named = sources.join(begun, F.shiftright("at", 33) == F.col("part"))
    named = named.select(F.col("source").alias("name"), "n", (F.col("at") - F.col("first") + F.col("before")).alias("grp"))
    # Both sides of this join are small; rows then meet their partition's start, so no source is a hot key.
    starts = parts.join(named, parts["source"].eqNullSafe(named["name"])).select(F.col("source").alias("of"), "part", "first", "before", "grp", "n")
    where = (F.shiftright("at", 33) == F.col("part")) & numbered["source"].eqNullSafe(F.col("of"))
    pos = (F.col("at") - F.col("first") + F.col("before")).alias("pos")
    return numbered.join(starts, where).select("grp", "n", pos, F.col("leaf").alias("digest"), "tampered", F.col("at").alias("leaf_id"), "doc_id")


def linked_level(rows: DataFrame, level: int, *payload: str) -> DataFrame:
    """Node rows of one stored level, from rows (grp, n, pos, digest) in groups of n.

    ``around`` holds the siblings on each side, level by level, up to the block's root; ``up_*`` links to
    that root's row (the source's place in the top tree if it is a source's root, null if it is the root of
    all); ``top`` is the root's digest, held by the first row of a block.
    """
    kid = F.struct("pos", "digest", *payload)
    blocks = rows.groupBy("grp", "n", F.floor(F.col("pos") / BLOCK).alias("block")).agg(F.sort_array(F.collect_list(kid)).alias("kids"))
    tower = blocks.withColumn("d0", F.transform("kids", lambda x: F.lower(F.hex(x["digest"]))))
    for height in range(LEVELS):
        tower = tower.withColumn(f"d{height + 1}", runs_above(F.col(f"d{height}")))
    needed = reduce(lambda built, height: built.when(F.col("n") <= FANOUT**height, height), range(1, LEVELS), F.when(F.col("n") <= 1, 0)).otherwise(LEVELS)
    top = F.element_at(F.array(*[F.element_at(f"d{height}", 1) for height in range(LEVELS + 1)]), F.col("levels") + 1)
    each = tower.withColumn("levels", needed).select("*", F.posexplode("kids").alias("i", "kid"))

    def around(height: int) -> Column:
        digests, i = F.col(f"d{height}"), F.floor(F.col("i") / FANOUT**height).cast("int")
        run = i - i % FANOUT
        before = F.slice(digests, run + 1, i - run)
        after = F.slice(digests, i + 2, run + FANOUT - 1 - i)
        return F.struct(F.unhex(F.array_join(before, "")).alias("before"), F.unhex(F.array_join(after, "")).alias("after"))

    over = F.ceil(F.col("n") / BLOCK)
    last = over == 1
    ends = F.col("grp") == TOP
    return each.select(
        "grp",
        F.lit(level).alias("level"),
        F.col("kid.pos").alias("pos"),
        F.col("kid.digest").alias("digest"),
        F.slice(F.array(*[around(height) for height in range(LEVELS)]), F.lit(1), F.col("levels")).alias("around"),
        F.when(~last, F.col("grp")).when(~ends, F.lit(TOP)).cast("bigint").alias("up_grp"),
        F.when(~last, F.lit(level + 1)).when(~ends, F.lit(0)).alias("up_level"),
        F.when(~last, F.col("block")).when(~ends, F.col("grp")).alias("up_pos"),
        over.alias("over"),
        F.when(F.col("i") == 0, F.unhex(top)).alias("top"),
        *[F.col(f"kid.{name}").alias(name) for name in payload],
    )


def built(rows: DataFrame, *payload: str) -> list[DataFrame]:
    """The written levels of the trees over rows (grp, n, pos, digest), the lowest first."""
    levels: list[DataFrame] = []
    while True:
        levels.append(written(linked_level(rows, len(levels), *(payload if not levels else ()))))
        above = levels[-1].where("top IS NOT NULL AND over > 1")
        if not above.take(1):
            return levels
        rows = above.select("grp", F.col("over").alias("n"), F.floor(F.col("pos") / BLOCK).alias("pos"), F.col("top").alias("digest"))


def roots(levels: list[DataFrame]) -> DataFrame:
    """(grp, digest) of each tree's root."""
    return reduce(DataFrame.unionByName, [x.where("top IS NOT NULL AND over = 1").select("grp", F.col("top").alias("digest")) for x in levels])


def manifest(docs: DataFrame) -> tuple[DataFrame, DataFrame, bytes]:
    """(leaf rows, node rows above them, root): the trees as parent-linked rows."""
    trees = built(ordered_leaves(docs), "tampered", "leaf_id", "doc_id")
    subroots = written(roots(trees))
    sources = subroots.count()
    upper = built(subroots.select(F.lit(TOP).cast("bigint").alias("grp"), F.lit(sources).cast("bigint").alias("n"), F.col("grp").alias("pos"), "digest"))
    links = ["around", "up_grp", "up_level", "up_pos"]
    inner = [x.select("grp", "level", "pos", *links, F.lit(None).cast("binary").alias("subroot")) for x in trees[1:]]
    outer = [x.select("grp", "level", "pos", *links, F.when(F.col("level") == 0, F.col("digest")).alias("subroot")) for x in upper]
    found = roots(upper).first()  # one row
    return trees[0], reduce(DataFrame.unionByName, inner + outer), bytes(found.digest) if found else b""


def verified(docs: DataFrame) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of each row, the digests as text."""
    leaves, nodes, root = manifest(docs)

    def folded(start: Column) -> Column:
        return F.aggregate("around", start, lambda held, s: F.unhex(F.sha2(F.lower(F.hex(F.concat(s["before"], held, s["after"]))).cast("binary"), 256)))

    siblings = F.aggregate("around", F.lit(b""), lambda held, s: F.concat(held, s["before"], s["after"]))
    start = leaves.select("leaf_id", folded(F.col("tampered")).alias("folded"), siblings.alias("siblings"), "up_grp", "up_level", "up_pos")
    climbed = docs.sparkSession.sql(CLIMB, leaves=start, nodes=nodes)
    own = leaves.select("leaf_id", F.lit(-1).alias("step"), F.lit(None).cast("binary").alias("hash"), F.lit(b"").alias("siblings"), F.lit(None).cast("binary").alias("subroot"), "doc_id", "digest")
    rows = climbed.withColumns({"doc_id": F.lit(None).cast("bigint"), "digest": F.lit(None).cast("binary")}).unionByName(own)
    proof = F.transform(F.sort_array(F.collect_list(F.struct("step", "siblings"))), lambda x: F.lower(F.hex(x["siblings"])))
    done = rows.groupBy("leaf_id").agg(
        F.max("doc_id").alias("doc_id"),
        F.max("digest").alias("leaf"),
        F.max("subroot").alias("subroot"),
        F.max_by("hash", "step").alias("folded"),
        text_hash(proof).alias("proof_sha256"),
    )
    named = F.lit(root.hex())
    told = F.lower(F.hex("folded"))
    return done.select(
        "doc_id",
        F.lower(F.hex("leaf")).alias("leaf"),
        F.lower(F.hex("subroot")).alias("subroot"),
        named.alias("root"),
        "proof_sha256",
        told.alias("folded_root"),
        (told == named).alias("verified"),
    )
