"""Mixing sources to target weights by Pareto order sampling, in DataFrame functions only.

Targets: the sources in code-point order (null last) have the weights 1, 2, 3, repeating, and
share all words by weight; a target stops at ``max_copies`` times its source's words and what is
cut off is shared again among the rest, until no target is above its bound.

Copies: inside a source a document of length class k is wanted ``c * weight_k`` times, at most
``max_copies`` times, with c such that the expected words are the target. The whole part is
certain. The rest f is an inclusion probability, which differs between classes: documents are
ranked by random odds over inclusion odds, u/(1-u) / (f/(1-f)), and taken in that order up to
the number of words that is still missing (a sample of fixed size, counted in words). At the
border, documents that do not fit any more are passed over for later ones that do, and the
document nearest to what is then missing is added if that comes nearer to the target.
Documents are always taken whole.

Scale: no window spans a source. Ranks are cut into buckets of about ``BUCKET_ROWS`` documents;
a source is decided by the running words of its buckets, and only the bucket at the border is
sorted and gathered. A source with a third of all rows thus has many small buckets. Draws are hashes of
seed and doc_id, so reruns and repeated tasks agree. Rows that share source and doc_id are drawn by a
digest of all their columns too, and rows equal in all columns by their running number as well
(``tie_draws``), so that many rows of one doc_id fill many buckets.

Edge cases: null texts have size 0; documents of size 0 are never taken; repeated rows are documents of their
own, each with its draw; a null doc_id is drawn like a value of its own; an empty table gives an empty result; other columns are carried through, helper columns are named ``_m_...``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from monthmill.llm.common import spread_lookup, with_plain_names, word_count
from monthmill.operators.ordering import global_rank
from monthmill.workspace import Workspace

MAX_COPIES = 3
#: Documents of at least so many words have so much weight inside their source.
CLASSES = ((0, 2), (100, 3), (1000, 4))
BUCKET_ROWS = 1000
#: Equal rows are numbered in runs of so many neighbouring rows of the table.
RUN_ROWS = 8192
#: What a chance may be off by rounding.
NOTHING = 1e-12


def draw(key: Column, seed: int) -> Column:
    """A number strictly between 0 and 1 that depends on ``key`` and ``seed`` alone."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("null")))
    digits = F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double")
    return (digits + 0.5) / F.lit(float(2**52))


def digest(df: DataFrame) -> Column:
    """A hash of all columns of a row; maps and variants, which have no hash, as JSON."""
    plain = [
        F.to_json(F.struct(f"`{name}`")) if "map<" in kind or "variant" in kind else F.col(f"`{name}`")
        for name, kind in df.dtypes
    ]
    return F.xxhash64(*plain, F.concat(*[F.col(f"`{name}`").isNull().cast("string") for name in df.columns]))


def tie_draws(base: DataFrame, space: Workspace, total: int, seed: int) -> DataFrame:
    """``base`` with a draw of its own, ``_m_u``, for every row that shares source and key with others.

    Rows equal in all columns are numbered: by the rows of earlier runs, then inside their run.
    Which of them has which number changes nothing, as they are equal.
    """
    same = ["_m_group", "_m_name"]
    ties = base.groupBy(*same).agg(F.count(F.lit(1)).alias("_m_equal")).filter(F.col("_m_equal") > 1)
    ties = space.write(ties, "mix-ties")
    if ties.isEmpty():
        return base
    rows = base.select("_m_row", *same, "_m_digest")
    tied = spread_lookup(rows, ties, same, "_m_equal", total).filter(F.col("_m_equal").isNotNull())
    run = ["_m_tie", "_m_run"]
    tied = tied.select(
        "_m_row", F.sha2(F.concat_ws(":", "_m_group", "_m_name", "_m_digest"), 256).alias("_m_tie"),
        F.expr(f"_m_row div {RUN_ROWS}").alias("_m_run"),
    )
    inside = Window.partitionBy(*run).orderBy("_m_row")
    tied = space.write(tied.withColumn("_m_number", F.row_number().over(inside)), "mix-tied")
    # one row per run, of which a table has few; a window over all runs of equal rows stays small
    earlier = Window.partitionBy("_m_tie").orderBy("_m_run").rowsBetween(Window.unboundedPreceding, -1)
    runs = tied.groupBy(*run).agg(F.count(F.lit(1)).alias("_m_in_run"))
    runs = runs.withColumn("_m_earlier", F.coalesce(F.sum("_m_in_run").over(earlier), F.lit(0)))
    numbers = tied.join(runs, run).select("_m_row", (F.col("_m_number") + F.col("_m_earlier")).alias("_m_number"))
    drawn = base.join(numbers, "_m_row", "left")
    own = draw(F.concat_ws(":", "_m_name", "_m_digest", "_m_number"), seed)
    drawn = drawn.withColumn("_m_u", F.when(F.col("_m_number").isNull(), F.col("_m_u")).otherwise(own))
    return space.write(drawn.drop("_m_number"), "mix-drawn")


def source_targets(sizes: DataFrame) -> DataFrame:
    """Targets for a table with one row per source: ``_m_source`` and ``_m_source_size``."""
    ranked = global_rank(sizes, [F.col("_m_source").asc_nulls_last()], "_m_rank")
    left = ranked.withColumn("_m_weight", (F.col("_m_rank") - 1) % 3 + 1)
    left = left.withColumn("_m_bound", MAX_COPIES * F.col("_m_source_size"))
    bounded: DataFrame | None = None
    total = left.agg(F.sum("_m_source_size")).first()[0] or 0
    # each round fixes the targets that reach their bound; no source can be fixed twice
    while True:
        weights = left.agg(F.sum("_m_weight")).first()[0] or 0
        if not weights:
            break
        share = F.lit(total).cast("decimal(38,0)") * F.col("_m_weight")
        above = left.filter(share > F.col("_m_bound").cast("decimal(38,0)") * weights)
        words = above.agg(F.sum("_m_bound")).first()[0]
        if words is None:
            break
        bounded = above if bounded is None else bounded.unionByName(above)
        left = left.filter(share <= F.col("_m_bound").cast("decimal(38,0)") * weights)
        total -= words
    share = F.lit(float(total)) * F.col("_m_weight") / F.lit(float(weights or 1))
    done = left.withColumn("_m_target", share.cast("double"))
    if bounded is not None:
        done = done.unionByName(bounded.withColumn("_m_target", F.col("_m_bound").cast("double")))
    return done.select("_m_source", "_m_source_size", "_m_target")


def class_of(size: Column) -> Column:
    number = F.lit(0)
    for k, (least, _) in enumerate(CLASSES):
        number = F.when(size >= least, F.lit(k)).otherwise(number)
    return number


def wanted_copies(words: list[Column], target: Column) -> list[Column]:
    """Expected copies per class from the words of each class: proportional to the class weights,
    at most MAX_COPIES, and the target in sum. The heaviest classes reach the bound first."""
    zero = F.lit(0).cast("bigint")
    copies: list[Column] = [F.lit(float(MAX_COPIES))] * len(words)
    for full in reversed(range(len(words))):  # so many of the heaviest classes at the bound
        free = len(words) - full
        weighed = sum((weight * words[k] for k, (_, weight) in enumerate(CLASSES[:free])), zero)
        fixed = sum((MAX_COPIES * words[k] for k in range(free, len(words))), zero)
        rate = (target - fixed.cast("double")) / F.nullif(weighed, zero).cast("double")
        fits = F.coalesce((rate * CLASSES[free - 1][1] <= MAX_COPIES) & (rate >= 0), F.lit(False))
        copies = [
            F.when(fits, rate * CLASSES[k][1] if k < free else F.lit(float(MAX_COPIES))).otherwise(copies[k])
            for k in range(len(words))
        ]
    return copies


def bucketed(base: DataFrame, plan: DataFrame, total: int) -> DataFrame:
    """The documents with the plan of their source, their place in the order and their bucket."""
    rows = spread_lookup(base, plan, ["_m_group"], "_m_rows", total)
    chance = F.get("_m_chance", F.col("_m_class"))
    odds = F.col("_m_u") / (1 - F.col("_m_u"))
    # documents without words change nothing; those without a chance are decided
    order = F.when((chance > 0) & (F.col("_m_size") > 0), odds / (chance / (1 - chance)))
    rows = rows.withColumn("_m_order", order).withColumn("_m_sure", F.get("_m_sure", F.col("_m_class")))
    # odds at the mean chance spread the buckets evenly; any monotone map gives the same result
    mean = F.greatest(F.col("_m_mean"), F.lit(NOTHING))
    scaled = F.col("_m_order") * mean / F.greatest(1 - mean, F.lit(NOTHING))
    bucket = F.floor(scaled / (1 + scaled) * F.col("_m_buckets"))
    # least passes over nulls: decided documents must not fill the last bucket
    return rows.withColumn("_m_bucket", F.when(bucket.isNotNull(), F.least(bucket, F.col("_m_buckets") - 1)))


def decide(
    docs: DataFrame, space: Workspace, keep: list[str], text: str, source: str, key: str, seed: int
) -> DataFrame:
    """Every document with its plan and copies, all in helper columns; ``keep`` is carried along."""
    base = space.write(
        docs.select(
            *[F.col(name).alias(f"_m_keep_{k}") for k, name in enumerate(keep)],
            F.col(source).alias("_m_source"),
            F.col(key).cast("string").alias("_m_key"),
            word_count(F.col(text)).alias("_m_size"),
            draw(F.col(key), seed).alias("_m_u"),
            F.monotonically_increasing_id().alias("_m_row"),
            digest(docs).alias("_m_digest"),
        ).withColumn("_m_class", class_of(F.col("_m_size")))
        # nulls are a source of their own; joins need a value
        .withColumn("_m_group", F.concat(F.when(F.col("_m_source").isNull(), "n").otherwise("s"),
                                         F.coalesce("_m_source", F.lit(""))))
        .withColumn("_m_name", F.concat(F.when(F.col("_m_key").isNull(), "n").otherwise("s"),
                                        F.coalesce("_m_key", F.lit("")))),
        "mix-base",
    )
    base = tie_draws(base, space, base.count(), seed).drop("_m_row", "_m_digest", "_m_name")
    per_source = base.groupBy("_m_group").agg(
        F.first("_m_source").alias("_m_source"),
        F.sum("_m_size").alias("_m_source_size"),
        F.count(F.lit(1)).alias("_m_rows"),
        *[F.coalesce(F.sum(F.when(F.col("_m_class") == k, F.col("_m_size"))), F.lit(0)).alias(f"_m_words_{k}")
          for k in range(len(CLASSES))],
    )
    per_source = space.write(per_source, "mix-sources")
    total = per_source.agg(F.sum("_m_rows")).first()[0] or 0
    targets = source_targets(per_source.select("_m_source", "_m_source_size")).drop("_m_source_size")
    plan = per_source.withColumnRenamed("_m_source", "_m_name").join(
        targets, F.col("_m_name").eqNullSafe(F.col("_m_source"))
    ).drop("_m_name", "_m_source")
    words = [F.col(f"_m_words_{k}") for k in range(len(CLASSES))]
    plan = plan.withColumn("_m_copies", F.array(*wanted_copies(words, F.col("_m_target"))))
    for k in range(len(CLASSES)):
        expected = F.least(F.get("_m_copies", k), F.lit(float(MAX_COPIES)))
        # a whole number but for rounding is one, or all documents would have nearly the same order
        expected = F.when(F.abs(expected - F.round(expected)) < NOTHING, F.round(expected)).otherwise(expected)
        plan = plan.withColumn(f"_m_sure_{k}", F.floor(expected).cast("bigint"))
        plan = plan.withColumn(f"_m_chance_{k}", expected - F.floor(expected))
    sure = sum((F.col(f"_m_sure_{k}") * words[k] for k in range(len(CLASSES))), F.lit(0))
    open_words = sum(
        (F.when(F.col(f"_m_chance_{k}") > 0, words[k]).otherwise(F.lit(0)) for k in range(len(CLASSES))),
        F.lit(0),
    )
    plan = plan.withColumn("_m_missing", F.col("_m_target") - sure.cast("double"))
    plan = plan.withColumn("_m_mean", F.col("_m_missing") / F.nullif(open_words, F.lit(0)).cast("double"))
    plan = plan.withColumn("_m_buckets", (F.col("_m_rows") / BUCKET_ROWS).cast("bigint") + 1)
    plan = space.write(
        plan.select("_m_group", "_m_rows", "_m_source_size", "_m_target", "_m_missing", "_m_mean", "_m_buckets",
                    F.array(*[F.col(f"_m_sure_{k}") for k in range(len(CLASSES))]).alias("_m_sure"),
                    F.array(*[F.col(f"_m_chance_{k}") for k in range(len(CLASSES))]).alias("_m_chance")),
        "mix-plan",
    )

    sums = bucketed(base, plan, total).filter(F.col("_m_bucket").isNotNull())
    sums = sums.groupBy("_m_group", "_m_bucket").agg(
        F.sum("_m_size").alias("_m_in"), F.first("_m_missing").alias("_m_missing")
    )
    before = Window.partitionBy("_m_group").orderBy("_m_bucket").rowsBetween(
        Window.unboundedPreceding, -1
    )
    sums = sums.withColumn("_m_before", F.coalesce(F.sum("_m_in").over(before), F.lit(0)))
    border = sums.filter(
        (F.col("_m_before") <= F.col("_m_missing")) & (F.col("_m_before") + F.col("_m_in") > F.col("_m_missing"))
    ).select(
        "_m_group", F.col("_m_bucket").alias("_m_border"),
        (F.col("_m_missing") - F.col("_m_before")).alias("_m_rest"),
    )
    bordered = space.write(plan.join(border, "_m_group", "left"), "mix-border")
    dealt = bucketed(base, bordered, total)
    decided = dealt.filter(F.coalesce(F.col("_m_bucket") != F.col("_m_border"), F.lit(True)))
    extra = F.when(F.col("_m_bucket").isNull(), 0).when(F.col("_m_border").isNull(), 1).when(
        F.col("_m_bucket") < F.col("_m_border"), 1
    ).otherwise(0)
    decided = decided.withColumn("_m_extra", extra)

    at_border = dealt.filter(F.col("_m_bucket") == F.col("_m_border"))
    order = Window.partitionBy("_m_group").orderBy("_m_order", "_m_key", "_m_size")
    at_border = at_border.withColumn("_m_place", F.row_number().over(order))
    # first fit in the order of the ranks: what does not fit any more is passed over
    listed = at_border.groupBy("_m_group").agg(
        F.first("_m_rest").alias("_m_rest"),
        F.sort_array(F.collect_list(F.struct("_m_place", F.col("_m_size").cast("double").alias("size")))).alias("_m_list"),
    )

    def next_one(state: Column, row: Column) -> Column:
        fits = row["size"] <= state["rest"]
        return F.struct(
            F.when(fits, state["rest"] - row["size"]).otherwise(state["rest"]).alias("rest"),
            F.concat(state["taken"], F.array(fits)).alias("taken"),
        )

    start = F.struct(F.col("_m_rest").alias("rest"), F.array().cast("array<boolean>").alias("taken"))
    listed = listed.withColumn("_m_state", F.aggregate("_m_list", start, next_one))
    # what is still missing then is closed by the document nearest to it, if that comes nearer
    rest, taken = F.col("_m_state")["rest"], F.col("_m_state")["taken"]
    misses = F.transform(
        F.filter("_m_list", lambda row: ~F.get(taken, row["_m_place"] - 1)),
        lambda row: F.struct(F.abs(row["size"] - rest).alias("miss"), row["_m_place"].alias("place")),
    )
    nearest = F.array_min(misses)
    listed = listed.select(
        "_m_group", taken.alias("_m_fits"), F.when(nearest["miss"] < rest, nearest["place"]).alias("_m_close")
    )
    at_border = at_border.join(listed, "_m_group")
    fits = F.get("_m_fits", F.col("_m_place") - 1) | F.col("_m_place").eqNullSafe(F.col("_m_close"))
    at_border = at_border.withColumn("_m_extra", F.when(fits, 1).otherwise(0))
    at_border = at_border.drop("_m_place", "_m_fits", "_m_close")
    both = decided.unionByName(at_border)
    copies = F.when(F.col("_m_size") > 0, F.col("_m_sure") + F.col("_m_extra")).otherwise(0).cast("bigint")
    return both.withColumn("_m_taken", copies)


def mix(
    docs: DataFrame,
    space: Workspace,
    keep: list[str] | None = None,
    text: str = "text",
    source: str = "source",
    key: str = "doc_id",
    seed: int = 7,
) -> DataFrame:
    """The columns ``keep`` (the key by default) of every document, with its ``size``, its
    source's ``source_size`` and ``target``, its ``copies`` and the ``taken`` words."""
    keep = [key] if keep is None else keep
    return decide(docs, space, keep, text, source, key, seed).select(
        *[F.col(f"_m_keep_{k}").alias(name) for k, name in enumerate(keep)],
        F.col("_m_size").alias("size"), F.col("_m_source_size").alias("source_size"),
        F.col("_m_target").alias("target"), F.col("_m_taken").alias("copies"),
        (F.col("_m_taken") * F.col("_m_size")).alias("taken"),
    )


def mixed_documents(
    docs: DataFrame,
    space: Workspace,
    text: str = "text",
    source: str = "source",
    key: str = "doc_id",
    seed: int = 7,
) -> DataFrame:
    """The mix itself: the columns of ``docs``, each document as often as it is taken."""
    used = (text, source, key)
    return with_plain_names(docs, used, lambda plain: _mixed_documents(plain, space, text, source, key, seed))


def _mixed_documents(
    docs: DataFrame, space: Workspace, text: str, source: str, key: str, seed: int
) -> DataFrame:
    names = list(docs.columns)
    taken = decide(docs, space, names, text, source, key, seed).filter(F.col("_m_taken") > 0)
    copy = F.explode(F.sequence(F.lit(1), F.col("_m_taken").cast("int"))).alias("_m_copy")
    kept = [F.col(f"_m_keep_{k}").alias(name) for k, name in enumerate(names)]
    return taken.select(*kept, copy).drop("_m_copy")
