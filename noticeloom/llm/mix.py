"""Problem 8: records of several sources mixed to target shares of the tokens, by Pareto order sampling.

A source's target over its tokens is the mean number of copies of its texts. The whole part
of it is given to every text. For the rest a text's chance grows with its size: it is the
size times a factor at which the expected tokens are what is left of the target, and 1 for
texts so long that this exceeds it, which are certain. Texts are ranked by random odds over
inclusion odds (Pareto order) and the first ones are taken until what is left is filled, a
sample of fixed size in tokens. The factor comes from sums over size classes (bounded:
sources x some eight classes an octave); the rank at which the target is reached from a
histogram of the ranks (bounded: sources x cells), and an exact running sum only inside the
one cell in which it lies, so no source is ever sorted as a whole.

Cases: null and empty texts and texts without a source or of a source without target are
never chosen; sources without any token get nothing, and their weight is spread over the
others in proportion; a null or negative weight is 0; ties in rank are broken by id;
repeated rows are texts of their own; empty tables give empty tables; other columns are
ignored. The same seed gives the same choice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from noticeloom.llm.tokens import token_counts
from noticeloom.session import small, table, written

CELLS = 4096
SEED = 20


def targets(sized: DataFrame, goals: DataFrame, total: int | None = None) -> DataFrame:
    """``source, peso_alvo, max_repeticoes, n_docs, n_tokens, share, target, whole, part``.

    Without ``total`` the mixture is as large as the shares and the repetition limits allow;
    with it, a source stays below its share where its limit binds.
    """
    sums = sized.groupBy("source").agg(F.count("*").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
    goals = goals.where("source is not null").groupBy("source").agg(F.sum(F.greatest(F.coalesce("peso_alvo", F.lit(0.0)), F.lit(0.0))).alias("peso_alvo"), F.max(F.coalesce("max_repeticoes", F.lit(1))).alias("max_repeticoes"))
    t = goals.join(sums, "source", "left").na.fill(0, ["n_docs", "n_tokens"])
    one = Window.partitionBy(F.lit(1))  # the reference table of targets: a handful of rows
    can = (F.col("n_tokens") > 0) & (F.col("peso_alvo") > 0) & (F.col("max_repeticoes") > 0)
    t = t.withColumn("share", F.when(can, F.col("peso_alvo") / F.sum(F.when(can, F.col("peso_alvo"))).over(one)).otherwise(0.0))
    most = F.when(F.col("share") > 0, F.col("n_tokens") * F.col("max_repeticoes") / F.col("share"))
    size = F.lit(float(total)) if total is not None else F.min(most).over(one)
    t = t.withColumn("target", F.when(F.col("share") > 0, F.least(size * F.col("share"), (F.col("n_tokens") * F.col("max_repeticoes")).cast("double"))).otherwise(0.0))
    mean = F.when(F.col("n_tokens") > 0, F.col("target") / F.col("n_tokens")).otherwise(0.0)
    return t.withColumn("whole", F.floor(mean + 1e-12).cast("int")).withColumn("part", F.greatest(mean - F.floor(mean + 1e-12), F.lit(0.0)))


def chances(rows: DataFrame) -> DataFrame:
    """``source, factor``: what a text's tokens are multiplied by for its chance, from ``source, n_tokens, open`` (tokens wanted).

    The classes of the longest texts are certain as long as the factor for the others would
    give one of them more than certainty; null if all texts must be.
    """
    size = F.floor(F.log2(F.col("n_tokens").cast("double")) * 8).cast("int")
    classes = rows.groupBy("source", size.alias("class")).agg(F.sum("n_tokens").alias("t"), F.sum(F.col("n_tokens").cast("double") ** 2).alias("t2"), F.max("n_tokens").alias("longest"), F.first("open").alias("open"))
    down = Window.partitionBy("source").orderBy(F.desc("class"))  # a few hundred classes a source at most
    certain = F.coalesce(F.sum("t").over(down.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    factor = (F.col("open") - certain) / F.sum("t2").over(down.rowsBetween(0, Window.unboundedFollowing))
    ok = classes.withColumn("factor", factor).where((F.col("factor") > 0) & (F.col("factor") * F.col("longest") <= 1))
    return ok.groupBy("source").agg(F.max_by("factor", "class").alias("factor"))


def mixed(sized: DataFrame, goals: DataFrame, total: int | None = None, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """``(doc_id, source, n_tokens, copies; the shares reached)`` from ``doc_id, source, n_tokens``."""
    sized = written(sized.where("n_tokens > 0 and source is not null").select("doc_id", "source", "n_tokens", F.monotonically_increasing_id().alias("row")), "mix-sized")
    plan = written(targets(sized, goals, total), "mix-plan")
    rows = sized.join(small(plan.select("source", "target", "whole", "part", F.col("n_tokens").alias("all_tokens"))), "source").where("target > 0")
    drawn = rows.where("part > 0").select("source", "n_tokens", (F.col("part") * F.col("all_tokens")).alias("open"))
    rows = rows.join(small(written(chances(drawn), "mix-chances")), "source", "left")
    u = (F.pmod(F.xxhash64("doc_id", "row", F.lit(seed)), F.lit(1 << 52)).cast("double") + 0.5) / float(1 << 52)
    chance = F.col("n_tokens") * F.col("factor")
    # the certain ones come first, in random order
    odds = F.when(F.col("part") > 0, F.when(chance < 1, (u / (1 - u)) / (chance / (1 - chance))).otherwise(u * 1e-9))
    rows = rows.withColumn("rank", odds).withColumn("cell", F.when(F.col("rank").isNotNull(), F.floor(F.col("rank") / (1 + F.col("rank")) * CELLS).cast("int")))
    # the cell in which the running sum of the ranked tokens crosses what the whole copies leave open
    cells = rows.where("cell is not null").groupBy("source", "cell").agg(F.sum("n_tokens").alias("tokens"), F.first("part").alias("part"), F.first("all_tokens").alias("all_tokens"))
    run = Window.partitionBy("source").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)  # at most CELLS rows a source
    before = cells.withColumn("before", F.coalesce(F.sum("tokens").over(run), F.lit(0)))
    edge = before.where((F.col("before") < F.col("part") * F.col("all_tokens")) & (F.col("before") + F.col("tokens") >= F.col("part") * F.col("all_tokens"))).groupBy("source").agg(F.min("cell").alias("edge"), F.min("before").alias("edge_before"))
    rows = rows.join(small(written(edge, "mix-edge")), "source", "left")
    inside = Window.partitionBy("source", "cell").orderBy("rank", "doc_id", "row").rowsBetween(Window.unboundedPreceding, -1)
    at_edge = rows.where("cell = edge").withColumn("sum_before", F.col("edge_before") + F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
    # a text is taken if at least half of it lies below the target
    at_edge = at_edge.withColumn("more", (F.col("sum_before") + F.col("n_tokens") / 2 <= F.col("part") * F.col("all_tokens")).cast("int")).drop("sum_before")
    rest = rows.where("cell is null or edge is null or cell <> edge").withColumn("more", F.when(F.col("cell").isNotNull() & (F.col("edge").isNull() | (F.col("cell") < F.col("edge"))), 1).otherwise(0))
    chosen = rest.unionByName(at_edge).select("doc_id", "source", "n_tokens", (F.col("whole") + F.col("more")).alias("copies")).where("copies > 0")
    chosen = written(chosen, "mix-chosen")
    got = chosen.groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("copies")).alias("tokens_chosen"), F.max("copies").alias("most_copies"))
    report = plan.join(got, "source", "left").na.fill(0, ["tokens_chosen", "most_copies"])
    report = report.withColumn("share_reached", F.col("tokens_chosen") / F.sum("tokens_chosen").over(Window.partitionBy(F.lit(1))))
    return chosen, report.select("source", "peso_alvo", "max_repeticoes", "n_docs", "n_tokens", "share", "target", "tokens_chosen", "most_copies", "share_reached")


def _mixture(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixed(token_counts(docs), table(spark, sf_dir, "mistura_alvo"))


def p8_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The texts chosen with their copies; beside each the share its source reached."""
    chosen, report = _mixture(spark, sf_dir)
    return chosen.join(small(report.select("source", F.col("peso_alvo").alias("share_wanted"), "share_reached")), "source")


def p8_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mixture(spark, sf_dir)[1]
