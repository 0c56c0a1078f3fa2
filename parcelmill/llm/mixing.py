"""Mixing of sources to target weights by a low-discrepancy schedule; built-in functions only.

Each source is to give a share of the corpus's words by its weight, and at most ``times`` its own size; what is
above is shared again among the other sources by weight until none is above. A source's documents are shuffled,
by a hash of id and text, laid end to end and cut into blocks of ``block`` words, the last one shorter. A source
needs as many slots of the schedule as its whole passes and the blocks of its last, broken pass are; the last slot
takes the head of its block, so that a source gives just the whole number next to its target.

The schedule has ``2^m`` points, the van der Corput sequence: point ``i`` lies at its own bits in reverse, as an
integer of ``m`` bits. The slots of all sources lie side by side from 0 on, and a point belongs to the source whose
stretch it falls in; as the points are all integers once, each source gets exactly its slots, spread evenly over the
schedule. Points beyond the last stretch are void. Slot number ``j`` of a source, by its rank in the schedule, is
joined with block ``j mod blocks`` and its documents.

Sums along a source (starts of documents, ranks of slots) go in two steps, within a chunk of bounded size and over
the sums of the chunks, so that no task holds a hot source. One row per source passes through one task: a corpus
has some millions at most.

Defined cases: a word is a run without ASCII white space; a null text has size 0; a source of null is one like
others, after them; documents of size 0 are never taken; repeated rows are counted and placed each, and hashed
rows of one id and text stand side by side; null ids are no special case; other columns are ignored; with no rows,
or none with words, nothing is taken.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelmill import session

TIMES = 3
BLOCK = 1024
CHUNK_ROWS = 4096  # documents of a source that are placed together, on average
CHUNK_POINTS = 1 << 16  # points of the schedule whose slots are ranked together
COPIES = 10_000  # equal rows that one task writes out

WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def sizes(docs: DataFrame) -> DataFrame:
    """``doc_id, source, size, place`` of every row; the place is its shuffled position within the source."""
    key = F.concat_ws(" ", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.coalesce("text", F.lit("")))
    return docs.select("doc_id", F.col("source").cast("string").alias("source"), word_count().alias("size"), F.md5(key).alias("place"))


def _exact(name: str) -> Column:
    return F.col(name).cast("decimal(19,0)")


def targets(sized: DataFrame, times: int = TIMES, block: int = BLOCK) -> DataFrame:
    """One row per source: number, weight (1, 2, 3, repeating), size, target, whole words, slots and the first of them."""
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    one = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    one = one.withColumn("no", F.row_number().over(by_name)).withColumn("weight", (F.col("no") - 1) % 3 + 1)
    one = one.withColumn("most", F.col("source_size") * times)
    # sources by the level at which they are full: all up to one level are, and the rest share what is left
    level = Window.orderBy(F.col("most").cast("decimal(28,9)") / F.col("weight"), "no")
    everything = Window.partitionBy()
    one = one.select(
        "*",
        F.sum("source_size").over(everything).alias("total"),
        F.coalesce(F.sum("most").over(level.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"),
        F.sum("weight").over(level.rowsBetween(0, Window.unboundedFollowing)).alias("rest"),
    )
    one = one.withColumn("left", F.col("total") - F.col("before"))
    one = one.withColumn("free", _exact("most") * _exact("rest") > _exact("left") * _exact("weight"))
    one = one.withColumns(
        {
            "shared": F.col("total") - F.coalesce(F.sum(F.when(~F.col("free"), F.col("most"))).over(everything), F.lit(0)),
            "parts": F.sum(F.when(F.col("free"), F.col("weight"))).over(everything),
        }
    )
    one = one.withColumn("share", F.col("shared") * F.col("weight"))
    one = one.withColumns(
        {
            "target": F.when(F.col("free"), F.col("share").cast("double") / F.col("parts")).otherwise(F.col("most").cast("double")),
            "whole": F.when(F.col("free"), F.expr("(2 * share + parts) div (2 * parts)")).otherwise(F.col("most")),
            "blocks": F.expr(f"(source_size + {block} - 1) div {block}"),
        }
    )
    one = one.withColumn("broken", F.when(F.col("source_size") > 0, F.expr("whole % source_size")).otherwise(F.lit(0)))
    one = one.withColumn("broken_blocks", F.expr(f"(broken + {block} - 1) div {block}"))
    one = one.withColumn("slots", F.when(F.col("source_size") > 0, F.expr("whole div source_size * blocks + broken_blocks")).otherwise(F.lit(0)))
    first = F.coalesce(F.sum("slots").over(Window.orderBy("no").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return one.select("no", "source", "weight", "source_size", "target", "whole", "blocks", "broken", "broken_blocks", "slots", first.alias("first"))


def _running(rows: DataFrame, keys: list[str], chunk: str, amount: Column, name: str) -> DataFrame:
    """``keys, chunk, name``: the sum of the amounts of all earlier chunks."""
    sums = rows.groupBy(*keys, chunk).agg(F.sum(amount).alias(name))
    before = Window.partitionBy(*keys).orderBy(chunk).rowsBetween(Window.unboundedPreceding, -1)
    return sums.select(*keys, chunk, F.coalesce(F.sum(name).over(before), F.lit(0)).alias(name))


def schedule(sources: DataFrame, block: int = BLOCK) -> DataFrame:
    """``position, no, pass, block, words`` of every slot; the position is that in the schedule."""
    spark = sources.sparkSession
    n, many = sources.agg(F.coalesce(F.sum("slots"), F.lit(0)), F.count("*")).first()
    bits = max(1, (n - 1).bit_length())
    cell = max(1, (1 << bits) // (2 * max(1, many)))  # a source lies in few cells, and a cell in few sources
    reverse = F.conv(F.reverse(F.lpad(F.bin("position"), bits, "0")), 2, 10).cast("long")
    points = spark.range((1 << bits) if n else 0).select(F.col("id").alias("position")).withColumn("at", reverse).filter(F.col("at") < n)
    points = points.withColumn("cell", F.expr(f"at div {cell}L"))
    cells = F.explode(F.expr(f"sequence(first div {cell}L, (first + slots - 1) div {cell}L)"))
    stretches = sources.filter("slots > 0").select("*", cells.alias("cell"))
    inside = points.join(stretches, "cell").filter("at >= first AND at < first + slots")
    inside = inside.withColumn("chunk", F.expr(f"position div {CHUNK_POINTS}")).select("position", "chunk", "no")
    inside = session.stage(inside, "slots")
    ranked = inside.join(_running(inside, ["no"], "chunk", F.lit(1), "rank"), ["no", "chunk"])
    rank = F.col("rank") + F.row_number().over(Window.partitionBy("no", "chunk").orderBy("position")) - 1
    dealt = ranked.withColumn("rank", rank).join(sources, "no")
    words = F.when(
        (F.col("rank") == F.col("slots") - 1) & (F.col("broken") > 0), F.expr(f"broken - (broken_blocks - 1) * {block}")
    ).otherwise(F.expr(f"least({block}, source_size - rank % blocks * {block})"))
    return dealt.select("position", "no", F.expr("rank div blocks").alias("pass"), F.expr("rank % blocks").alias("block"), words.alias("words"))


def places(sized: DataFrame, sources: DataFrame) -> DataFrame:
    """``no, doc_id, size, start`` of every row with words: where it stands in its source's shuffled documents."""
    rows = sized.count()
    digits = next(d for d in range(16) if rows <= CHUNK_ROWS * 16**d)
    numbered = sized.filter("size > 0").join(sources.select("no", F.col("source").alias("name")), F.col("source").eqNullSafe(F.col("name")))
    chunk = F.conv(F.substring("place", 1, digits), 16, 10).cast("long") if digits else F.lit(0).cast("long")
    equal = numbered.groupBy("no", chunk.alias("chunk"), "place", "doc_id", "size").agg(F.count("*").alias("copies"))
    equal = session.stage(equal, "placed")
    amount = F.col("size") * F.col("copies")
    earlier = Window.partitionBy("no", "chunk").orderBy("place", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    within = equal.join(_running(equal, ["no"], "chunk", amount, "before"), ["no", "chunk"])
    within = within.withColumn("start", F.col("before") + F.coalesce(F.sum(amount).over(earlier), F.lit(0)))
    # equal rows are written out in lots, by many tasks
    lots = within.select("*", F.explode(F.expr(f"sequence(0L, copies - 1, {COPIES}L)")).alias("lot"))
    lots = lots.withColumn("from", F.col("start") + F.col("lot") * F.col("size")).repartition("no", "from")
    each = F.explode(F.expr(f"sequence(0L, least({COPIES}L, copies - lot) - 1)"))
    return lots.select("no", "doc_id", "size", "from", each.alias("copy")).select(
        "no", "doc_id", "size", (F.col("from") + F.col("copy") * F.col("size")).alias("start")
    )


def mixed(placed: DataFrame, slots: DataFrame, block: int = BLOCK) -> DataFrame:
    """The pieces of documents that the slots take: ``position, pass, no, doc_id, size, start, skip, words``.

    ``skip`` words of the document come before the piece. Pieces of blocks that no slot takes have a null position.
    In order of position and of ``start`` this is the mix.
    """
    blocks = F.explode(F.expr(f"sequence(start div {block}, (start + size - 1) div {block})"))
    pieces = placed.select("*", blocks.alias("block"))
    pieces = pieces.withColumn("begin", F.greatest("start", F.col("block") * block))
    pieces = pieces.withColumn("end", F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * block))
    taken = F.greatest(F.lit(0), F.least("end", F.col("block") * block + F.col("words")) - F.col("begin"))
    joined = pieces.join(slots, ["no", "block"], "left")
    return joined.select(
        "position", "pass", "no", "doc_id", "size", "start",
        (F.col("begin") - F.col("start")).alias("skip"),
        F.when(F.col("position").isNotNull(), taken).otherwise(F.lit(0)).alias("words"),
    )


def mix(docs: DataFrame, times: int = TIMES, block: int = BLOCK) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Sizes of all rows, the sources with their targets, and the pieces of the mix."""
    sized = session.stage(sizes(docs), "sizes")
    sources = session.stage(targets(sized, times, block), "sources")
    return sized, sources, mixed(places(sized, sources), schedule(sources, block), block)


def taken(docs: DataFrame, times: int = TIMES, block: int = BLOCK) -> DataFrame:
    """Each row's ``doc_id, size``, its source's size and target, and how many words of it the mix takes."""
    sized, sources, pieces = mix(docs, times, block)
    each = pieces.groupBy("no", "start").agg(F.first("doc_id").alias("doc_id"), F.first("size").alias("size"), F.sum("words").alias("taken"))
    with_words = each.join(sources, "no").select("doc_id", "size", "source_size", "target", "taken")
    blank = sized.filter("size = 0").join(sources.withColumnRenamed("source", "name"), F.col("source").eqNullSafe(F.col("name")))
    return with_words.unionByName(blank.select("doc_id", "size", "source_size", "target", F.lit(0).cast("long").alias("taken")))


def oracle() -> str:
    """The same by plain sums: a source's shuffled documents are gone round as often as its target says."""
    return rf"""
WITH s AS (SELECT doc_id, source, len(list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> ''))::BIGINT AS size,
                  md5(concat(coalesce(doc_id::VARCHAR, ''), ' ', coalesce(text, ''))) AS place FROM documents),
t AS (SELECT source, sum(size)::BIGINT AS source_size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS w FROM s GROUP BY source),
f AS (SELECT a.source, {TIMES} * a.source_size * sum(b.w) FILTER (b.source_size * a.w >= a.source_size * b.w)
             > ((SELECT sum(source_size) FROM t) - coalesce(sum({TIMES} * b.source_size) FILTER (b.source_size * a.w < a.source_size * b.w), 0)) * a.w AS free
      FROM t a, t b GROUP BY a.source, a.source_size, a.w),
g AS (SELECT t.*, coalesce(free, false) AS free FROM t JOIN f ON t.source IS NOT DISTINCT FROM f.source),
h AS (SELECT *, (sum(source_size) OVER () - coalesce(sum({TIMES} * source_size) FILTER (NOT free) OVER (), 0))::BIGINT * w AS num,
             sum(w) FILTER (free) OVER () AS den FROM g),
k AS (SELECT source, source_size, CASE WHEN free THEN num::DOUBLE / den::DOUBLE ELSE {TIMES} * source_size::DOUBLE END AS target,
             CASE WHEN free THEN (2 * num + den) // (2 * den) ELSE {TIMES} * source_size END AS whole FROM h),
p AS (SELECT s.*, source_size, target, whole, sum(size) OVER (PARTITION BY s.source ORDER BY place, s.doc_id NULLS FIRST, size ROWS UNBOUNDED PRECEDING) - size AS start
      FROM s JOIN k ON s.source IS NOT DISTINCT FROM k.source)
SELECT doc_id, size, source_size, target,
       (CASE WHEN size = 0 THEN 0 ELSE whole // source_size * size + greatest(0, least(size, whole % source_size - start)) END)::BIGINT AS taken
FROM p"""
