from palimpsest.llm.mixing import mix, ranked, shares

SIZED = "doc_id long, source string, n_tokens long"


def frames(spark, docs, targets, totals):
    return (
        spark.createDataFrame(docs, SIZED), spark.createDataFrame(targets, "mix_name string, source string, target_share double, max_repeats int").selectExpr("*", "1 doc_id"),
        spark.createDataFrame(totals, "mix_name string, corpus_ratio double").selectExpr("*", "'x' source"),
    )


def test_shares_and_caps(spark):
    docs = [(i, "big" if i < 900 else "small", 10 + i % 50) for i in range(1000)] + [(2000, None, 99), (2001, "other", 50), (2002, "big", 0)]
    sized, targets, totals = frames(spark, docs, [("m", "big", 0.5, 1), ("m", "small", 0.5, 2), ("m", "absent", 0.2, 9), ("x", "big", None, 1)], [("m", 0.5), ("x", 0.5)])
    got = mix(sized, targets, totals.drop("source")).collect()
    assert max(r.repeats for r in got if r.source == "small") <= 2 and max(r.repeats for r in got if r.source == "big") == 1
    rows = {r.source: r for r in shares(mix(sized, targets, totals.drop("source")), sized, targets, totals.drop("source")).collect()}
    goal = rows["big"].goal_tokens
    assert abs(rows["big"].tokens - goal) <= 120 and rows["absent"].tokens == 0
    # the small source is short of its target: every document twice
    assert rows["small"].documents == 100 and rows["small"].tokens == 2 * sum(n for _, s, n in docs if s == "small")


def test_ranks_are_a_numbering(spark):
    sized = spark.createDataFrame([(i, "s" if i % 3 else "t", 1 + i % 7) for i in range(500)], SIZED)
    for s in ("s", "t"):
        r = sorted(x.rank for x in ranked(sized).where(f"source = '{s}'").collect())
        assert r == list(range(len(r)))


def test_repeated_rows_and_empty(spark):
    sized, targets, totals = frames(spark, [(1, "a", 10)] * 4, [("m", "a", 1.0, 3)], [("m", 2.0)])
    assert sum(r.repeats for r in mix(sized, targets, totals.drop("source")).collect()) == 8
    none = sized.limit(0)
    assert mix(none, targets, totals.drop("source")).count() == 0
    assert shares(mix(none, targets, totals.drop("source")), none, targets, totals.drop("source")).first().actual_share == 0
