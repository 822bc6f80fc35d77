"""Q4 edge rows, and the pair-free algorithm against brute force on hot blocks."""

import random

import pytest
from pyspark.sql import functions as F

from clientlens.functions.scalar import email_prefix, normalize
from clientlens.operators import dedup
from clientlens.sources import schemas


def cust(spark, rows):
    return spark.createDataFrame(rows, schemas.CUSTOMERS)


def flagged(df):
    return {r.customer_id for r in dedup.dedupe_customers(df).filter("is_likely_duplicate").collect()}


def brute(spark, df, prefix_max=2):
    """All pairs in a block, the rule verbatim."""
    n = df.select("customer_id", normalize("last_name").alias("ln"), normalize("first_name").alias("fn"),
                  email_prefix("email").alias("ep"), "state")
    a, b = n.alias("a"), n.alias("b")
    p = (a.join(b, (F.col("a.ln") == F.col("b.ln")) & (F.col("a.customer_id") < F.col("b.customer_id")))
         .filter((F.levenshtein("a.fn", "b.fn") <= 1) & (F.levenshtein("a.ep", "b.ep") <= prefix_max)
                 & (F.col("a.state") == F.col("b.state"))))
    return {r[0] for r in p.select("b.customer_id").distinct().collect()}, p.count()


def test_edge_rows(spark):
    rows = [
        ("01", "Maria", "Lopez", "maria.lopez@x.com", "2024-01-01", "Gold", "TX"),
        ("02", "Mraia", "Lopez", "maria.lopez@y.com", "2024-01-01", "Gold", "TX"),   # swap: distance 2
        ("03", "Mari", "Lopez", "maria.lopez@z.com", "2024-01-01", "Gold", "TX"),    # dropped char: match 01
        ("04", "Maria", "Lopez", "maria.lopez@q.com", "2024-01-01", "Gold", None),   # null state
        ("05", "Maria", None, "maria.lopez@q.com", "2024-01-01", "Gold", "TX"),      # null last name
        ("06", "maria ", " lopez ", "maria.lopez@w.com", "2024-01-01", "Gold", "TX"),  # case/space
        ("07", "Maria", "Lopez", "marialopez", "2024-01-01", "Gold", "TX"),         # no @: prefix = whole
        ("10", "Ann", "Ng", "ann@a.com", "2024-01-01", "Gold", "CA"),
        ("11", "Ann", "Ng", "ann@b.com", "2024-01-01", "Gold", "CA"),
        ("12", "Ann", "Ng", "ann@c.com", "2024-01-01", "Gold", "CA"),                # three mutual
    ]
    df = cust(spark, rows)
    got = flagged(df)
    assert got == {"03", "06", "07", "11", "12"}
    assert got == brute(spark, df)[0]
    assert dedup.dedupe_customers(df).count() == len(rows)          # nothing removed


def test_matches_brute_force_with_hot_blocks(spark):
    rnd = random.Random(7)
    names = ["anna", "anne", "ann", "annie", "bob", "rob", "robb", "john", "jon", "joan"]
    rows = []
    for i in range(600):
        fn = rnd.choice(names)
        if rnd.random() < 0.3:
            fn = fn + rnd.choice("xy")
        ln = rnd.choice(["smith", "smith", "smith", "lee"])          # one hot block
        ep = f"{fn}.{ln}{rnd.randint(1, 6)}"
        rows.append((f"{i:05d}", fn, ln, f"{ep}@mail.com", "2024-01-01", "Gold", rnd.choice(["CA", "CA", "NY"])))
    df = cust(spark, rows)
    want, pairs = brute(spark, df)
    assert {r.customer_id for r in dedup.flagged_ids(df).collect()} == want
    assert dedup.likely_duplicate_pair_count(df).first()[0] == pairs


@pytest.mark.parametrize("prefix_max", [0, 1, 2, 3])
def test_every_prefix_distance_is_exact_on_a_large_key_group(spark, prefix_max):
    """One first name, hundreds of prefixes: equal, near and far ones, empty and
    short ones, edits at the front, in the middle and at the end."""
    rnd = random.Random(prefix_max)
    base = ["annleeabcdef", "annleeabcxyz", "", "a", "ab", "ba", "abc", "abcabcabcabc", "zannleeabcdef", "annleeabcde"]
    prefixes = list(base)
    while len(prefixes) < 400:
        p = list(rnd.choice(base[:2] + base[7:]))
        for _ in range(rnd.randint(0, 4)):
            i = rnd.randint(0, len(p))
            kind = rnd.random()
            if kind < 0.4:
                p.insert(i, rnd.choice("abx"))
            elif p and i < len(p):
                p[i:i + 1] = [] if kind < 0.7 else [rnd.choice("abx")]
        prefixes.append("".join(p))
    df = cust(spark, [(f"{i:05d}", "ann", "lee", f"{p}@x", "2024-01-01", "Gold", "CA") for i, p in enumerate(prefixes)])
    want, pairs = brute(spark, df, prefix_max)
    assert {r.customer_id for r in dedup.flagged_ids(df, prefix_max=prefix_max).collect()} == want
    assert dedup.likely_duplicate_pair_count(df, prefix_max=prefix_max).first()[0] == pairs


def test_unsupported_distances_are_refused(spark):
    df = cust(spark, [("1", "Ann", "Lee", "ann@x.com", "2020-01-01", "Gold", "CA")])
    for wrong in ({"prefix_max": 4}, {"prefix_max": -1}, {"first_max": 2}):
        with pytest.raises(ValueError):
            dedup.flagged_ids(df, **wrong)


def test_duplicate_ids_follow_reference_rules(spark):
    rows = [("A", "Ann", "Ng", "ann@a", "2024-01-01", "Gold", "CA"),
            ("A", "Anne", "Ng", "ann@b", "2024-01-01", "Gold", "CA"),   # same id: never a pair
            ("B", "Ann", "Ng", "ann@c", "2024-01-01", "Gold", "CA")]
    df = cust(spark, rows)
    assert flagged(df) == brute(spark, df)[0] == {"B"}
    assert dedup.likely_duplicate_pair_count(df).first()[0] == brute(spark, df)[1] == 2


def test_evaluation(spark):
    flags = spark.createDataFrame([("a", True), ("b", True), ("c", False), ("d", True)],
                                  "customer_id string, is_likely_duplicate boolean")
    truth = spark.createDataFrame([("b", "c"), ("e", "f")], schemas.DUPLICATE_KEY)
    r = dedup.evaluate_dedup(flags, truth).first()
    assert (r.true_positives, r.false_positives, r.false_negatives) == (1, 2, 3)
    assert abs(r.precision - 1 / 3) < 1e-12 and abs(r.recall - 0.25) < 1e-12
    flags2 = flags.withColumn("first_name", F.lit("x")).withColumn("last_name", F.lit("y")) \
                  .withColumn("email", F.lit("e")).withColumn("state", F.lit("s"))
    fp = {r.customer_id for r in dedup.dedup_false_positives(flags2, truth).collect()}
    assert fp == {"a", "d"}
    assert [r.customer_id for r in dedup.dedup_false_positive_sample(flags2, truth, 1).collect()] == ["a"]


def test_block_sizes(spark):
    df = cust(spark, [
        ("1", "Ann", "Lee ", "ann@x.com", "2020-01-01", "Gold", "CA"),
        ("2", "ann", "lee", "ann@y.com", "2020-01-01", "Gold", "CA"),     # same comparison values as 1
        ("3", "Bob", "Lee", "bob@x.com", "2020-01-01", "Gold", "CA"),
        ("4", "Bob", "Lee", "bob@x.com", "2020-01-01", "Gold", "NV"),
        ("5", "Cy", "Lee", "cy@x.com", "2020-01-01", "Gold", None),         # no state: in no block
    ])
    got = {(r.last_name_norm, r.state): (r.customers, r.distinct_values)
           for r in dedup.block_sizes(df).collect()}
    assert got == {("lee", "CA"): (3, 2), ("lee", "NV"): (1, 1)}


@pytest.mark.parametrize("k", [0, 1, 2, 3])
def test_probe_keys_meet_every_near_string_and_are_few(spark, k):
    """Every pair within distance k shares a key (the longer one probes), for all
    lengths from 0; the number of keys does not exceed its bound."""
    from clientlens.functions.text import probe_segments, segments
    rnd = random.Random(k)
    words = {"".join(rnd.choice("ab") for _ in range(rnd.randint(0, 7))) for _ in range(120)}
    words |= {"".join(rnd.choice("abc") for _ in range(rnd.randint(8, 14))) for _ in range(60)}
    for w in list(words):
        x = list(w)
        for _ in range(rnd.randint(1, 3)):
            i = rnd.randint(0, len(x))
            x[i:i + rnd.randint(0, 1)] = rnd.choice(["", "a", "c"])
        words.add("".join(x))
    df = spark.createDataFrame([(w,) for w in sorted(words)], "w string")
    keys = df.select("w", probe_segments(F.col("w"), k).alias("p"), segments(F.col("w"), k).alias("s")).checkpoint()
    a, b = keys.select(F.col("w").alias("a"), "p"), keys.select(F.col("w").alias("b"), "s")
    met = (a.crossJoin(b).filter((F.length("a") >= F.length("b")) & (F.levenshtein("a", "b") <= k))
           .select("a", "b", F.arrays_overlap("p", "s").alias("ok")))
    assert met.filter("not ok").collect() == []
    bound = sum((k * k - d * d) // 2 + k + 1 for d in range(k + 1))
    assert keys.agg(F.max(F.size("p"))).first()[0] <= bound and bound == {0: 1, 1: 4, 2: 12, 3: 26}[k]


@pytest.mark.parametrize("few", [1, 3, 1000])
def test_keys_of_few_and_of_many_groups_match_alike(spark, monkeypatch, few):
    """The same pairs whether the groups of a first-name key meet directly or by
    prefix segments."""
    rnd = random.Random(5)
    rows = [(f"{rnd.randint(0, 150):05d}", rnd.choice(["Customer#17", "Customer#18", "Customer#27", "ann"]), rnd.choice(["lee", "ng"]),
             f"m{rnd.randint(10, 40)}.{rnd.randint(0, 30)}@x.com", "2024-01-01", "Gold", rnd.choice(["CA", "NY", None])) for _ in range(200)]
    df = cust(spark, rows)
    monkeypatch.setattr(dedup, "FEW", few)
    want, pairs = brute(spark, df)
    assert {r.customer_id for r in dedup.flagged_ids(df).collect()} == want
    assert dedup.likely_duplicate_pair_count(df).first()[0] == pairs


def test_groups_of_a_name_meet_once_and_edges_are_not_sorted(spark):
    """Copies of a customer under other e-mails share every key of their name: each
    pair of them is found once, not once a key, and edges are hashed, not sorted."""
    rows = [(f"{i:05d}", name, "lee", f"m01.{i % 20}@x.com", "2024-01-01", "Gold", "CA")
            for i, name in enumerate(["Customer#000000011"] * 20 + ["Customer#000000012"] * 20)]
    df = cust(spark, rows)
    groups, edges = dedup.matching_groups(df)
    want, pairs = brute(spark, df)
    assert groups.count() == 40 and edges.count() == 2 * pairs == 40 * 39
    assert {r.customer_id for r in dedup.flagged_ids(df).collect()} == want
    plan = dedup.flagged_ids(df)._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan
