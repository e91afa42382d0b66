"""Mixing of sources to target numbers of words by entropy balancing, with DataFrame functions only.

Targets: sources in code-point order (null last) have repeating weights and share ``share`` times all
words; a target stops at ``most`` times its source's words, and the excess is shared again by weight.

Rates: the document rates that meet the targets and stay closest (in relative entropy, by words) to taking
every word once are exponentially tilted, ``exp(lambda of the source)``; Newton iterations on the convex dual find
the lambdas, each with one aggregate over the corpus' (source, size) counts. Only a residual comes to the driver.

Copies: a rate's whole part is taken by every document, its fraction by those whose hash lies below the source's
cut. The cut is found over hash bins, then within the one bin where it lies, so that the words taken
reach the target up to one document; single documents, largest first, then fill what is missing.

Defined results: null text has no words; null source is a source; a source without words has target 0; equal
(doc_id, size) rows share their hash and are taken alike; a null doc_id is a value like others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, shared_dir

WORD = r"[^\x20\x09-\x0D]+"
#: Bits of a document's hash; bins of them, at least LEAST_BINS and so many that one holds about ROWS_PER_BIN rows of a source.
HASH_BITS, LEAST_BINS, ROWS_PER_BIN = 40, 1024, 100_000
FILL_PASSES = 4


def _size() -> Column:
    return F.coalesce(F.regexp_count(F.col("text").cast("string"), F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def targets(by_source: DataFrame, weights: tuple[float, ...], share: float, most: float) -> DataFrame:
    """(source, source_size) with the target of each; one row per source goes through the two orderings."""
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.pmod(F.row_number().over(Window.orderBy(F.col("source").isNull(), "source")) - 1, F.lit(len(weights))) + 1).cast("int"))
    t = by_source.withColumn("weight", w).withColumn("cap", F.col("source_size") * F.lit(float(most)))
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), "source")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    t = t.withColumn("capped", F.coalesce(F.sum("cap").over(before), F.lit(0.0))).withColumn("open", F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing)))
    t = t.withColumn("level", (F.lit(float(share)) * F.sum("source_size").over(whole) - F.col("capped")) / F.col("open"))
    # the first source in this order whose cap the level does not pass fixes the level, which only falls
    # from there on; if there is none, all are capped
    t = t.withColumn("level", F.max(F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.col("level"))).over(whole))
    return t.select("source", "source_size", F.coalesce(F.least(F.col("level") * F.col("weight"), F.col("cap")), F.col("cap")).alias("target"))


def tilts(counts: DataFrame, goal: DataFrame, tolerance: float = 1e-9, most_rounds: int = 80) -> DataFrame:
    """goal with lambda: Newton on sum(n * size * exp(lambda)) - target * lambda for each source."""
    shared_dir(goal.sparkSession)
    state = goal.withColumn("lam", F.lit(0.0)).checkpoint()
    for _ in range(most_rounds):
        mass = counts.join(state.select(F.col("source").alias("s"), "lam"), F.col("source").eqNullSafe(F.col("s")))
        mass = mass.groupBy("source").agg(F.sum(F.col("n") * F.col("size") * F.exp("lam")).alias("mass"))
        mass = mass.select(F.col("source").alias("s"), "mass")
        step = F.when((F.col("mass") > 0) & (F.col("target") > 0), F.greatest(F.lit(-2.0), F.least(F.lit(2.0), F.col("target") / F.col("mass") - 1))).otherwise(F.lit(0.0))
        state = state.join(mass, F.col("source").eqNullSafe(F.col("s")), "left").withColumn("step", step).withColumn("lam", F.col("lam") + F.col("step"))
        state = state.drop("s", "mass").checkpoint()
        if (state.agg(F.max(F.abs("step"))).first()[0] or 0.0) < tolerance:
            break
        state = state.drop("step")
    else:
        raise RuntimeError("the dual did not settle")
    return state.drop("step")


def mixture(docs: DataFrame, weights: tuple[float, ...] = (3.0, 1.0, 2.0), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """row (a struct of the columns of ``docs``), mix_size, mix_source_size, mix_target and mix_copies."""
    h = F.pmod(F.xxhash64("doc_id", _size()), F.lit(1 << HASH_BITS))
    sized = materialize(docs.select(F.col("source").cast("string").alias("source"), _size().alias("size"), h.alias("h")), "sizes")
    counts = materialize(sized.groupBy("source", "size").agg(F.count("*").alias("n")), "size-counts")
    n = counts.agg(F.sum("n")).first()[0] or 0
    bin_bits = HASH_BITS - max(LEAST_BINS.bit_length() - 1, (n // ROWS_PER_BIN).bit_length())
    by_source = counts.groupBy("source").agg(F.sum(F.col("n") * F.col("size")).alias("source_size"))
    goal = tilts(counts, targets(by_source, weights, share, most))

    rate = F.exp("lam")
    base = F.when(F.col("target") > 0, F.floor(rate + 1e-7)).otherwise(0).cast("int")
    goal = goal.withColumn("base", base).withColumn("need", F.greatest(F.lit(0.0), F.col("target") - F.col("base") * F.col("source_size")))
    goal = goal.withColumn("need", F.when(F.col("base") < most, F.col("need")).otherwise(0.0))

    def with_goal(rows: DataFrame, *cols: str) -> DataFrame:
        g = goal.select(F.col("source").alias("s"), *cols)
        return rows.join(g, F.col("source").eqNullSafe(F.col("s"))).drop("s")

    # the bin where each source's cut lies, then the cut within it
    bin_of = F.shiftright("h", bin_bits)
    bins = sized.groupBy("source", bin_of.alias("bin")).agg(F.sum("size").alias("words"))
    bins = bins.withColumn("upto", F.sum("words").over(Window.partitionBy("source").orderBy("bin")))
    edge = with_goal(bins, "need").where("upto > need").groupBy("source").agg(F.min(F.struct("bin", (F.col("upto") - F.col("words")).alias("before"))).alias("e"))
    edge = edge.select(F.col("source").alias("s"), "e.bin", "e.before")
    inside = with_goal(sized, "need").withColumn("b", bin_of).join(edge, F.col("source").eqNullSafe(F.col("s")) & (F.col("b") == F.col("bin")))
    # ties share a value of h, so the frame is by value
    inside = inside.withColumn("upto", F.col("before") + F.sum("size").over(Window.partitionBy("source").orderBy("h").rangeBetween(Window.unboundedPreceding, 0)))
    last = inside.where("upto <= need").groupBy("source").agg(F.max("h").alias("last"))
    last = last.select(F.col("source").alias("s2"), "last")
    cut = edge.join(last, F.col("s").eqNullSafe(F.col("s2")), "left").select("s", F.coalesce("last", F.shiftleft("bin", bin_bits) - 1).alias("cut"))
    goal = goal.join(cut, F.col("source").eqNullSafe(F.col("s")), "left").drop("s").withColumn("cut", F.coalesce("cut", F.when(F.col("need") > 0, F.lit(1 << HASH_BITS)).otherwise(F.lit(-1))))
    goal = goal.withColumn("picked", F.array().cast("array<bigint>")).checkpoint()

    # single documents for what is still missing
    taken = with_goal(sized, "cut").where("h <= cut").groupBy("source").agg(F.sum("size").alias("words")).select(F.col("source").alias("s"), "words")
    goal = goal.join(taken, F.col("source").eqNullSafe(F.col("s")), "left").withColumn("need", F.col("need") - F.coalesce("words", F.lit(0))).drop("s", "words").checkpoint()
    for _ in range(FILL_PASSES):
        fits = with_goal(sized, "need", "cut", "picked").where("h > cut and size > 0 and size <= need").where(~F.array_contains("picked", F.col("h")))
        pick = fits.groupBy("source", "size", "h").agg(F.sum("size").alias("words")).where(F.col("words") == F.col("size"))  # ties are taken together, so not here
        pick = pick.groupBy("source").agg(F.max(F.struct("size", "h")).alias("p")).select(F.col("source").alias("s"), "p")
        goal = goal.join(pick, F.col("source").eqNullSafe(F.col("s")), "left")
        goal = goal.withColumn("need", F.col("need") - F.coalesce("p.size", F.lit(0))).withColumn("picked", F.when(F.col("p").isNull(), F.col("picked")).otherwise(F.array_append("picked", F.col("p.h")))).drop("s", "p").checkpoint()

    # the documents' columns travel in one struct, so that none of their names can clash
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), F.col("source").cast("string").alias("doc_source"), h.alias("doc_h"), _size().alias("mix_size"))
    g = goal.select("source", F.col("source_size").alias("mix_source_size"), F.col("target").alias("mix_target"), "base", "cut", "picked")
    out = rows.join(g, F.col("doc_source").eqNullSafe(F.col("source")))
    extra = ((F.col("doc_h") <= F.col("cut")) | F.array_contains("picked", F.col("doc_h"))) & (F.col("base") < most)
    return out.select("row", "mix_size", "mix_source_size", "mix_target", (F.col("base") + extra.cast("int")).alias("mix_copies"))


def mix_report(docs: DataFrame, **options) -> DataFrame:
    """Columns doc_id, size, source_size, target, taken, copies."""
    m = mixture(docs.select("doc_id", "text", "source"), **options)
    return m.select(F.col("row.doc_id").alias("doc_id"), F.col("mix_size").alias("size"), F.col("mix_source_size").alias("source_size"), F.col("mix_target").alias("target"), (F.col("mix_size") * F.col("mix_copies")).alias("taken"), F.col("mix_copies").alias("copies"))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The documents as often as the mix takes them; columns as given."""
    m = mixture(docs, **options).where("mix_copies > 0")
    return m.select("row", F.explode(F.sequence(F.lit(1), F.col("mix_copies"))).alias("copy")).select("row.*")
