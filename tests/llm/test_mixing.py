from statuteloom.llm import mixing as m


def table(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, source string, tokens bigint")


def targets(spark, *rows):
    return spark.createDataFrame(list(rows), "source string, target_share double, max_repeats int")


def rate(spark, sized, goal, total=None):
    return {r.source: r.rate for r in m.rates(sized, goal, total=total).collect()}


def brute(sums, goal, total):
    """Water filling by repetition: cap what overflows, share the rest among the others."""
    open_, capped, rates = {s for s, share, cap in goal if sums.get(s) and share and cap}, set(), {}
    caps, shares = {s: c for s, _, c in goal}, {s: x for s, x, _ in goal}
    while open_:
        left = total - sum(caps[s] * sums[s] for s in capped)
        level = left / sum(shares[s] for s in open_)
        over = {s for s in open_ if level * shares[s] > caps[s] * sums[s] + 1e-9}
        if not over:
            break
        capped |= over
        open_ -= over
    for s in capped:
        rates[s] = float(caps[s])
    for s in open_:
        rates[s] = level * shares[s] / sums[s]
    return rates


def test_rates(spark):
    sized = table(spark, [(k, "a" if k % 3 else "b", 10) for k in range(90)] + [(1000, "c", 5)])
    goal = targets(spark, ("a", 0.5, 1), ("b", 0.3, 2), ("c", 0.0, 9), ("d", 0.2, 3))
    got = rate(spark, sized, goal)
    assert got["c"] == got["d"] == 0.0 and max(got["a"], got["b"] / 2) == 1.0
    assert abs(got["a"] * 600 / (got["b"] * 300) - 0.5 / 0.3) < 1e-9
    for total in (100, 700, 1000, 1200, 5000):
        want = brute({"a": 600, "b": 300, "c": 5}, [("a", 0.5, 1), ("b", 0.3, 2), ("c", 0.0, 9), ("d", 0.2, 3)], total)
        got = rate(spark, sized, goal, total)
        assert all(abs(got[s] - want[s]) < 1e-9 for s in want), total


def test_mix_and_report(spark):
    sized = table(spark, [(k, ("a", "b", "c")[k % 3], 1 + k % 7) for k in range(3000)])
    goal = targets(spark, ("a", 0.6, 2), ("b", 0.3, 2), ("c", 0.1, 2), ("none", 0.5, 2))
    rated = m.rates(sized, goal)
    mixed = m.mix(sized, rated, seed=1)
    rates = {r.source: r.rate for r in rated.collect()}
    uses = {(r.doc_id, r.source): r["count"] for r in mixed.groupBy("doc_id", "source").count().collect()}
    for (_, source), n in uses.items():
        assert n in (int(rates[source]), int(rates[source]) + 1) and n <= 2
    assert mixed.where("copy < 1").count() == 0
    shares = {r.source: r for r in m.report(mixed, rated).collect()}
    assert abs(shares["a"].actual_share - 0.6) < 0.02 and abs(shares["c"].actual_share - 0.1) < 0.02 and shares["none"].actual_share == 0.0
    again = m.mix(sized.repartition(5), rated, seed=1)
    assert again.exceptAll(mixed).count() == 0
    assert mixed.exceptAll(m.mix(sized, rated, seed=2)).count() > 0


def test_usable_nulls_and_empty_tables(spark):
    df = spark.createDataFrame([(1, "a", "x"), (2, None, "x"), (3, "a", None), (4, "a", " \n"), (5, "a", "")], "doc_id bigint, source string, text string")
    assert [r.doc_id for r in m.usable(df).collect()] == [1]
    none = table(spark, [(1, "a", 1)]).limit(0)
    rated = m.rates(none, targets(spark, ("a", 1.0, 1), (None, None, None)))
    assert {r.rate for r in rated.collect()} == {0.0} and m.mix(none, rated).count() == 0
    assert {r.actual_share for r in m.report(m.mix(none, rated), rated).collect()} == {None}
