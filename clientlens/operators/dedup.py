"""Fuzzy customer de-duplication (Q4) and its evaluation (Q18, Q19).

Match rule (per pair of rows a, b with ``a.customer_id < b.customer_id``):
same normalised last name, same state, ``levenshtein`` of normalised first
names <= 1 and of e-mail prefixes <= 2. The larger id of every matching
pair is flagged; no row is removed.

The pipeline never forms all pairs of a block. A block (last name, state) may
hold a third of all customers, so instead:

1. Rows with identical comparison values collapse to one *value group*
   (``min`` id, map-side combined). Inside a group every pair matches, so all
   members but the smallest id are flagged without forming pairs.
2. First names meet on a deletion-neighbourhood key (edit distance <= 1 implies a
   shared one), held as a hash of block and key. At most (length + 1) x (letters of
   the alphabet) names of a block share one, however many value groups a name has.
   Each name then has *links*: to itself and to the names within the distance.
3. Value groups meet along the links of their names, each pair of names once. Where
   a name has more than ``FEW`` groups, they meet on segments of the e-mail prefix
   too (of ``k + 1`` even segments, edit distance <= k leaves one untouched, moved
   by at most k places); the groups of other names meet directly, at most
   ``FEW`` x ``FEW`` for a link. Both ways are exact, whatever ``prefix_max`` from
   0 to 3 is.
4. Candidate group pairs are verified with the thresholded built-in
   ``levenshtein``.
5. A row is flagged when its id is larger than the smallest id of its own group, or
   when a matching group has a smaller id than that.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clientlens.functions.joins import by_merge
from clientlens.functions.scalar import email_prefix, normalize
from clientlens.functions.text import explode_deletion_keys_1, probe_segments, segments

FIRST_MAX = 1
PREFIX_MAX = 2
VALUE_COLS = ["_ln", "_st", "_fn", "_ep"]
FEW = 32                     # most value groups of a first name that meet without prefix segments


def _comparison_values(df: DataFrame) -> DataFrame:
    return (df.select("customer_id",
                      normalize("last_name").alias("_ln"),
                      F.col("state").alias("_st"),
                      normalize("first_name").alias("_fn"),
                      email_prefix("email").alias("_ep"))
              .filter(F.col("customer_id").isNotNull()
                      & F.col("_ln").isNotNull() & F.col("_st").isNotNull()
                      & F.col("_fn").isNotNull() & F.col("_ep").isNotNull()))


def _within(a: Column, b: Column, k: int) -> Column:
    return F.levenshtein(a, b, k) >= 0


def matching_groups(df: DataFrame, first_max: int = FIRST_MAX, prefix_max: int = PREFIX_MAX) -> tuple[DataFrame, DataFrame]:
    """Return (groups, edges).

    groups: one row per distinct comparison value (``VALUE_COLS``) with
            ``min_id`` and row count ``n``.
    edges:  ordered pairs of distinct matching groups of one block:
            (``_ln``, ``_st``, ``_fn``, ``_ep``, ``min_id``, ``o_fn``, ``o_ep``,
            ``other_min_id``); a pair found through several prefix segments may repeat.
    """
    if first_max != 1:
        raise ValueError("first-name neighbourhood keys are built for distance 1")
    if prefix_max not in range(4):
        raise ValueError("e-mail prefix segments are built for distances 0 to 3")
    # both tables below feed several branches; each is computed once and its
    # lineage cut, so the customer input is not re-scanned per branch
    groups = (_comparison_values(df).groupBy(*VALUE_COLS)
              .agg(F.min("customer_id").alias("min_id"), F.count(F.lit(1)).alias("n"))
              .checkpoint(eager=True))

    name = F.xxhash64("_ln", "_st", "_fn").alias("_name")
    names = groups.groupBy("_ln", "_st", "_fn").agg(F.count(F.lit(1)).alias("_groups")).select(
        name, "_ln", "_st", "_fn", "_groups", (F.col("_groups") > FEW).alias("_many"))
    keyed = (explode_deletion_keys_1(names, "_fn", "_fk")
             .select(F.xxhash64("_ln", "_st", "_fk").alias("_key"), "_name", "_fn", "_many"))
    near = (keyed.alias("a").join(by_merge(keyed.alias("b")), (F.col("a._key") == F.col("b._key"))
                                  & (F.struct("a._name", "a._fn") < F.struct("b._name", "b._fn"))
                                  & _within(F.col("a._fn"), F.col("b._fn"), first_max))
            .select(F.col("a._name").alias("_n"), F.col("b._name").alias("_o"), (F.col("a._many") | F.col("b._many")).alias("_many")))
    own = names.filter("_groups >= 2").select(F.col("_name").alias("_n"), F.col("_name").alias("_o"), "_many")
    links = near.unionByName(own).distinct().checkpoint(eager=True)

    of_names = groups.select(name, *VALUE_COLS, "min_id")
    # names are hashes: block and values decide
    matching = ((F.col("a._ln") == F.col("b._ln")) & (F.col("a._st") == F.col("b._st"))
                & _within(F.col("a._fn"), F.col("b._fn"), first_max)
                & _within(F.col("a._ep"), F.col("b._ep"), prefix_max))
    a, b = F.struct("a._fn", "a._ep"), F.struct("b._fn", "b._ep")

    def starting(some: DataFrame) -> DataFrame:
        return some.join(by_merge(of_names), F.col("_n") == F.col("_name")).select("_n", "_o", *VALUE_COLS, "min_id")

    found = starting(links.filter(~F.col("_many"))).alias("a").join(
        by_merge(of_names.alias("b")), (F.col("a._o") == F.col("b._name")) & ((F.col("a._n") != F.col("a._o")) | (a < b)) & matching)
    # the longer prefix probes: links of many groups are gone along both ways
    many = links.filter("_many").select("_n", "_o")
    ways = many.unionByName(many.filter("_n != _o").select(F.col("_o").alias("_n"), F.col("_n").alias("_o")))
    probing = starting(ways).withColumn("_seg", F.explode(probe_segments(F.col("_ep"), prefix_max)))
    held = (of_names.join(by_merge(ways.select(F.col("_o").alias("_name")).distinct()), "_name", "left_semi")
            .withColumn("_seg", F.explode(segments(F.col("_ep"), prefix_max))))
    split = probing.alias("a").join(by_merge(held.alias("b")), (F.col("a._o") == F.col("b._name")) & (F.col("a._seg") == F.col("b._seg"))
                                    & (a != b) & matching)

    def edge(x: str, y: str) -> Column:
        return F.struct(*[F.col(f"{x}.{c}").alias(c) for c in [*VALUE_COLS, "min_id"]], F.col(f"{y}._fn").alias("o_fn"),
                        F.col(f"{y}._ep").alias("o_ep"), F.col(f"{y}.min_id").alias("other_min_id"))

    # of each pair one order is found (the probing prefix is the longer one): both are edges
    def both(pairs: DataFrame) -> DataFrame:
        return pairs.select(F.explode(F.array(edge("a", "b"), edge("b", "a"))).alias("e")).select("e.*")

    return groups, both(found).unionByName(both(split))


def flagged_ids(df: DataFrame, **kw) -> DataFrame:
    """Distinct ids flagged as likely duplicates (the larger id of a matching pair)."""
    groups, edges = matching_groups(df, **kw)
    # whether a smaller id matches is enough: distinct groups are hashed, whereas the
    # smallest text of every edge would be found by sorting the edges
    beaten = edges.filter("other_min_id < min_id").select(*VALUE_COLS).distinct().withColumn("_beaten", F.lit(True))
    thresholds = groups.join(by_merge(beaten), VALUE_COLS, "left").select(*VALUE_COLS, "min_id", "_beaten")
    return (_comparison_values(df).join(by_merge(thresholds), VALUE_COLS)
            .filter(F.col("_beaten") | (F.col("customer_id") > F.col("min_id")))
            .select("customer_id").distinct())


def dedupe_customers(df: DataFrame, **kw) -> DataFrame:
    """Q4: all input rows plus ``is_likely_duplicate`` (NULL-free boolean)."""
    flags = flagged_ids(df, **kw).withColumn("is_likely_duplicate", F.lit(True))
    return (df.join(by_merge(flags), "customer_id", "left")
              .withColumn("is_likely_duplicate", F.coalesce(F.col("is_likely_duplicate"), F.lit(False)))
              .select(*df.columns, "is_likely_duplicate"))


def likely_duplicate_pair_count(df: DataFrame, **kw) -> DataFrame:
    """Number of matching row pairs (a.id < b.id), computed from group sizes.

    Pairs inside a value group: (n^2 - sum over ids of n_id^2) / 2. Pairs across
    two matching groups: n_u * n_v minus pairs whose two rows share an id.
    """
    groups, edges = matching_groups(df, **kw)
    per_id = _comparison_values(df).groupBy(*VALUE_COLS, "customer_id").agg(F.count(F.lit(1)).alias("c"))
    sq = per_id.groupBy(*VALUE_COLS).agg(F.sum(F.col("c") * F.col("c")).alias("sq"))
    inside = groups.join(by_merge(sq), VALUE_COLS).agg(
        F.sum((F.col("n") * F.col("n") - F.col("sq")) / 2).cast("bigint"))
    # distinct unordered group pairs inside a block
    und = (edges.filter(F.struct("_fn", "_ep") < F.struct("o_fn", "o_ep"))
           .select(*VALUE_COLS, "o_fn", "o_ep").distinct())
    other = groups.select("_ln", "_st", F.col("_fn").alias("o_fn"), F.col("_ep").alias("o_ep"),
                          F.col("n").alias("on"))
    across = (und.join(by_merge(groups.select(*VALUE_COLS, "n")), VALUE_COLS)
              .join(by_merge(other), ["_ln", "_st", "o_fn", "o_ep"])
              .agg(F.sum(F.col("n") * F.col("on"))))
    # a shared id lies in two value groups of the block at least: only such ids
    # meet, so a hot group is not multiplied by its number of neighbours
    several = per_id.groupBy("_ln", "_st", "customer_id").agg(F.count(F.lit(1)).alias("g")).filter("g >= 2").drop("g")
    split = per_id.join(by_merge(several), ["_ln", "_st", "customer_id"])
    a = split.alias("a")
    b = split.alias("b")
    both = (a.join(by_merge(b), (F.col("a._ln") == F.col("b._ln")) & (F.col("a._st") == F.col("b._st"))
                   & (F.col("a.customer_id") == F.col("b.customer_id"))
                   & (F.struct("a._fn", "a._ep") < F.struct("b._fn", "b._ep")))
            .select(*[F.col("a." + c).alias(c) for c in VALUE_COLS], F.col("b._fn").alias("o_fn"),
                    F.col("b._ep").alias("o_ep"), (F.col("a.c") * F.col("b.c")).alias("cc")))
    shared = both.join(by_merge(und), [*VALUE_COLS, "o_fn", "o_ep"], "left_semi").agg(F.sum("cc"))
    total = (F.coalesce(inside.scalar(), F.lit(0)) + F.coalesce(across.scalar(), F.lit(0))
             - F.coalesce(shared.scalar(), F.lit(0)))
    return df.sparkSession.range(1).select(total.cast("bigint").alias("likely_duplicate_pairs"))


def block_sizes(df: DataFrame) -> DataFrame:
    """Size of every (last name, state) block: rows and distinct comparison
    values (the skew report; pairs are never formed per block)."""
    cv = _comparison_values(df)
    return (cv.groupBy(*VALUE_COLS).agg(F.count(F.lit(1)).alias("n"))
            .groupBy(F.col("_ln").alias("last_name_norm"), F.col("_st").alias("state"))
            .agg(F.sum("n").cast("bigint").alias("customers"),
                 F.count(F.lit(1)).alias("distinct_values")))


# --- evaluation against an answer key -------------------------------------------------

def evaluate_dedup(customers_flagged: DataFrame, truth: DataFrame) -> DataFrame:
    """Q18: TP / FP / FN / precision / recall of the flagged ids.

    The truth set is both sides of every answer-key pair; denominators are
    floored at 1 as in a plain ratio report.
    """
    flagged = (customers_flagged.filter("is_likely_duplicate")
               .select("customer_id", F.lit(1).alias("f"), F.lit(0).alias("t")))
    truth_ids = (truth.select(F.col("customer_id"))
                 .unionByName(truth.select(F.col("is_duplicate_of").alias("customer_id")))
                 .select("customer_id", F.lit(0).alias("f"), F.lit(1).alias("t")))
    per_id = (flagged.unionByName(truth_ids).filter(F.col("customer_id").isNotNull())
              .groupBy("customer_id").agg(F.max("f").alias("f"), F.max("t").alias("t")))
    c = per_id.agg(F.count_if((F.col("f") == 1) & (F.col("t") == 1)).alias("true_positives"),
                   F.count_if((F.col("f") == 1) & (F.col("t") == 0)).alias("false_positives"),
                   F.count_if((F.col("f") == 0) & (F.col("t") == 1)).alias("false_negatives"))
    tp, fp, fn = F.col("true_positives"), F.col("false_positives"), F.col("false_negatives")
    return c.select(tp, fp, fn,
                    (tp / F.greatest(tp + fp, F.lit(1))).cast("double").alias("precision"),
                    (tp / F.greatest(tp + fn, F.lit(1))).cast("double").alias("recall"))


def dedup_false_positives(customers_flagged: DataFrame, truth: DataFrame) -> DataFrame:
    """Q19: flagged rows whose id is not on the ``customer_id`` side of the key."""
    return (customers_flagged.filter("is_likely_duplicate")
            .join(by_merge(truth.select("customer_id")), "customer_id", "left_anti")
            .select("customer_id", "first_name", "last_name", "email", "state"))


def dedup_false_positive_sample(customers_flagged: DataFrame, truth: DataFrame, n: int = 5) -> DataFrame:
    """The first ``n`` false positives by id (a report sample; the limit is the feature)."""
    return dedup_false_positives(customers_flagged, truth).orderBy("customer_id").limit(n)
