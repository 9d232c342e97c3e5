"""Mixing sources to target weights by Efraimidis-Spirakis sampling, with DataFrame functions only.

Sources in code-point order (null last) weigh 5, 2, 1, repeating, and share `share` times
the size of all documents by weight. A target stops at `most` times its source's size;
the excess is shared again by weight until no target is above.

A source takes its documents in whole epochs as long as its target allows, and the rest
from a weighted sample without replacement: document i gets the key -ln(u_i) / q_i, with
u_i uniform from a hash of id and text and q_i the quality weight, and documents are taken
in the order of their keys up to the token budget. The document that crosses the budget
is taken if that ends nearer to it, so a source misses its target by half a document at
most, and none is taken more than `most` times.

The keys of a source are cut into at most CELLS cells; the sums of the cells say in which one
the budget ends. While that cell holds more than 4 x CELL_ROWS rows it is cut again between
its own least and largest key, whatever the quality weights, and only the last one is sorted.
A source of any size is thus summed in parallel, and its rows are never brought together.

Defined cases: a null or empty text has size 0 and is taken 0 words; null sources are one
source; a null id takes part; a null or non-positive quality counts as the least. Ties of
keys go by id, then size; rows equal in id, text and source share a key and stand in any
order, with the same rows as result. An empty table gives an empty mix. Columns beside
those used are kept by `mixed`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from weirstone.llm.common import col, fresh, saved

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
CELL_ROWS = 2_000
CELLS = 4_096
LEAST_QUALITY = 0.1
WORD = r"[^\x20\x09-\x0D]+"
JUNK = "#$%&*<=>[\\]^_{|}~"


def size_of(text: Column) -> Column:
    """Number of words between white space; null counts as empty."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def text_quality(text: Column) -> Column:
    """1 for plain text, less by ten times the share of symbols that prose has not, at least LEAST_QUALITY."""
    n = F.length(text)
    junk = (n - F.length(F.translate(text, JUNK, ""))).cast("double")
    return F.when(n > 0, F.greatest(F.lit(1.0) - F.lit(10.0) * junk / n, F.lit(LEAST_QUALITY))).otherwise(F.lit(LEAST_QUALITY))


def uniform(doc_id: Column, text: Column) -> Column:
    """A number in (0, 1] from a hash of id and text: the first 52 bits of an MD5, plus one."""
    digest = F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit("|"), F.coalesce(text, F.lit(""))).cast("binary"))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") + 1).cast("double") / F.lit(float(1 << 52))


def sized(docs: DataFrame, doc_id: str, text: str, source: str, quality: Column | None) -> DataFrame:
    """(doc_id, source, size, key, spread): `spread` orders as `key` does, within [0, 1].

    Every step of 1 - 1 / (1 + key) is monotone in doubles, and for qualities from 0.1 to 1
    no stretch of it is more than six times as full as the others.
    """
    q = text_quality(col(text)) if quality is None else F.when(quality > 0, quality.cast("double")).otherwise(F.lit(LEAST_QUALITY))
    key = -F.log(uniform(col(doc_id), col(text))) / q
    slim = docs.select(col(doc_id).alias("doc_id"), col(source).alias("source"), size_of(col(text)).alias("size"), key.alias("key"))
    return slim.withColumn("spread", F.lit(1.0) - F.lit(1.0) / (F.lit(1.0) + F.col("key")))


def numbered(names: DataFrame) -> DataFrame:
    """Rows with `rank`, their place by `source` from 0, null last.

    Ranges of names are counted each on its own and begin where the ones before end.
    """
    ranged = names.repartitionByRange(F.col("source").asc_nulls_last()).withColumn("part", F.spark_partition_id())
    ranged = saved(ranged, "sources")
    parts = ranged.groupBy("part").agg(F.count("*").alias("n"))
    before = parts.withColumn("before", F.sum("n").over(Window.orderBy("part")) - F.col("n")).drop("n")
    own = F.row_number().over(Window.partitionBy("part").orderBy(F.col("source").asc_nulls_last()))
    return ranged.join(F.broadcast(before), "part").withColumn("rank", own + F.col("before") - 1).drop("part", "before")


def targets(sources: DataFrame, share: float, most: int, weights: tuple[int, ...]) -> DataFrame:
    """(source, n, source_size, target) from (source, n, source_size)."""
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    table = saved(numbered(sources).withColumn("weight", weight.cast("double")).drop("rank"), "weights")
    limit = (F.lit(most) * F.col("source_size")).cast("double")
    total = (table.agg(F.sum("source_size")).first()[0] or 0) * share
    rate = None
    while True:
        # Limited sources keep their limit; what is left goes to the others by weight.
        full = F.lit(False) if rate is None else F.lit(rate) * F.col("weight") > limit
        used, rest, n_full = table.agg(
            F.coalesce(F.sum(F.when(full, limit)), F.lit(0.0)), F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0.0)), F.count(F.when(full, 1))
        ).first()
        if rate is not None and n_full == last or rest == 0:
            break
        rate, last = (total - used) / rest, n_full
    return table.withColumn("target", F.least(limit, F.lit(rate or 0.0) * F.col("weight"))).drop("weight")


def narrowed(slim: DataFrame, goals: DataFrame, cell_rows: int) -> DataFrame:
    """`goals` with the cell of `spread` in which the budget of a source ends: `lo` and `hi`, its `rows`, and the size `before` it."""
    cell_of = ["lo", "hi", "rows", "before"]
    goals = goals.withColumns({"lo": F.lit(0.0), "hi": F.lit(1.0), "rows": F.col("n"), "before": F.lit(0).cast("long")}).drop("n")
    most = 4 * cell_rows
    while True:
        cells = F.when(F.col("rows") > most // 2, F.least(F.ceil(2 * F.col("rows") / cell_rows), F.lit(CELLS).cast("long"))).otherwise(F.lit(1).cast("long"))
        part = F.floor((F.col("spread") - F.col("lo")) / (F.col("hi") - F.col("lo")) * cells)
        inside = slim.join(goals, F.col("source").eqNullSafe(F.col("name"))).where("spread BETWEEN lo AND hi")
        inside = inside.withColumn("cell", F.when(F.col("hi") > F.col("lo"), F.least(part, cells - 1)).otherwise(F.lit(0).cast("long")))
        sums = inside.groupBy("name", "cell", "budget", "before").agg(
            F.sum("size").alias("held"), F.count("*").alias("rows"), F.min("spread").alias("lo"), F.max("spread").alias("hi")
        )
        upto = F.col("before") + F.sum("held").over(Window.partitionBy("name").orderBy("cell"))
        # The first cell whose running sum reaches the budget, and what lies before it.
        reached = sums.withColumn("upto", upto).where("upto >= budget").withColumn("before", F.col("upto") - F.col("held"))
        ends = reached.groupBy(F.col("name").alias("ending")).agg(F.min(F.struct("cell", *cell_of)).alias("end")).select("ending", *[f"end.{c}" for c in cell_of])
        goals = saved(goals.drop(*cell_of).join(ends, F.col("name").eqNullSafe(F.col("ending")), "left").drop("ending"), "goals")
        # A cell of one key alone cannot be cut; any other loses rows with every pass.
        if (goals.where("hi > lo").agg(F.max("rows")).first()[0] or 0) <= most:
            return goals


def plan(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", source: str = "source", quality: Column | None = None,
    share: float = SHARE, most: int = MOST, weights: tuple[int, ...] = WEIGHTS, cell_rows: int = CELL_ROWS,
) -> DataFrame:
    """(doc_id, source, key, size, source_size, target, copies): how often the mix takes each document."""
    slim = saved(sized(docs, doc_id, text, source, quality), "sizes")
    per_source = targets(slim.groupBy("source").agg(F.count("*").alias("n"), F.sum("size").alias("source_size")), share, most, weights)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    goals = per_source.withColumn("epochs", epochs.cast("long")).withColumn("budget", F.col("target") - F.col("epochs") * F.col("source_size"))
    goals = narrowed(slim, goals.withColumnRenamed("source", "name"), cell_rows)
    placed = slim.join(goals, F.col("source").eqNullSafe(F.col("name")))
    inner = F.coalesce(F.col("spread").between(F.col("lo"), F.col("hi")), F.lit(False))
    running = F.col("before") + F.sum("size").over(Window.partitionBy("source").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0))
    # Taken if at least half of the document fits: then taking it ends nearer to the budget.
    fits = (F.col("upto") - F.col("size") / 2) <= F.col("budget")
    edge = placed.where(inner).withColumn("upto", running)
    edge = edge.withColumn("extra", (fits & (F.col("upto") - F.col("size") < F.col("budget"))).cast("long")).drop("upto")
    whole = placed.where(~inner).withColumn("extra", F.coalesce(F.col("spread") < F.col("lo"), F.lit(False)).cast("long"))
    return edge.unionByName(whole).select("doc_id", "source", "key", "size", "source_size", "target", (F.col("epochs") + F.col("extra")).alias("copies"))


def mixed(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", source: str = "source", quality: Column | None = None,
    share: float = SHARE, most: int = MOST, weights: tuple[int, ...] = WEIGHTS, cell_rows: int = CELL_ROWS, copy: str = "copy",
) -> DataFrame:
    """The documents as often as the mix takes them, and a column for which copy a row is (from 1).

    That column is `copy`, with underscores appended where the documents have one of that name.
    Rows that agree in id, source, size and key have the same text up to a hash; they are
    counted together, and their copies spread over them.
    """
    copy, id_, from_, mark, own, times, place, rows = fresh(docs.columns, copy, "id", "from", "mark", "own", "times", "place", "rows")
    q = text_quality(col(text)) if quality is None else F.when(quality > 0, quality.cast("double")).otherwise(F.lit(LEAST_QUALITY))
    keyed = docs.withColumn(mark, -F.log(uniform(col(doc_id), col(text))) / q)
    chosen = plan(docs, doc_id=doc_id, text=text, source=source, quality=quality, share=share, most=most, weights=weights, cell_rows=cell_rows)
    taken = (
        chosen.groupBy("doc_id", "source", "key").agg(F.sum("copies").alias(times), F.count("*").alias(rows)).where(col(times) > 0)
        .select(F.col("doc_id").alias(id_), F.col("source").alias(from_), F.col("key").alias(own), times, rows)
    )
    same = col(doc_id).eqNullSafe(col(id_)) & col(source).eqNullSafe(col(from_)) & (col(mark) == col(own))
    found = keyed.join(taken, same)
    order = Window.partitionBy(col(id_), col(from_), col(own)).orderBy(F.lit(0))
    once = found.where(col(rows) == 1).withColumn(place, F.lit(0).cast("long"))
    more = found.where(col(rows) > 1).withColumn(place, (F.row_number().over(order) - 1).cast("long"))
    # Of k copies over r equal rows each row gets k / r, the first k % r one more.
    each = F.floor((col(times) + col(rows) - 1 - col(place)) / col(rows))
    copies = F.explode(F.when(each > 0, F.sequence(F.lit(1), each)).otherwise(F.array().cast("array<bigint>"))).alias(copy)
    return once.unionByName(more).select(*map(col, docs.columns), copies)
