"""Request-log analytics against brute force in Python."""

import random
from collections import defaultdict

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from reshelve.functions.rounding import round_binary
from reshelve.operators import ranks
from reshelve.plans import compare, latency
from reshelve.sources.request_log import conform_log, read_log

COLUMNS = ("start_ms bigint, elapsed bigint, label string, response_code string, "
           "response_message string, thread_name string, success string, bytes bigint, "
           "sent_bytes bigint, group_threads int, all_threads int, latency bigint, "
           "idle_time bigint, connect bigint")


def sample(start, elapsed, label, success="true", code="200", threads=1, thread="Group 1-1"):
    return (start, elapsed, label, code, "OK" if code == "200" else "broken", thread, success,
            10 * elapsed, 5, threads, threads, elapsed // 2, 0, 1)


def make_samples():
    rng = random.Random(7)
    rows = []
    for i in range(900):
        label = rng.choice(["a", "a", "b", "c"])
        bad = rng.random() < 0.1
        rows.append(sample(1_000_000 + i * 700, int(rng.expovariate(1 / 400)), label,
                           rng.choice(["false", "False", "FALSE"]) if bad else "true",
                           rng.choice(["500", "502"]) if bad else "200", rng.randint(1, 5),
                           f"Group {label} 1-{rng.randint(1, 5)}"))
    rows.append(sample(5_000, 42, "lonely"))
    rows += [sample(9_000_000 + i, 5_000 * (i % 3), "steps") for i in range(600)]
    return rows


SAMPLES = make_samples()


@pytest.fixture(scope="module")
def log(spark):
    return spark.createDataFrame(SAMPLES, COLUMNS).cache()


def legacy_percentile(values, thousandths):
    """Position p * (n + 1) with interpolation, clamped."""
    values = sorted(values)
    whole, rest = divmod(thousandths * (len(values) + 1), 1000)
    if whole < 1:
        return float(values[0])
    if whole >= len(values):
        return float(values[-1])
    return values[whole - 1] + rest / 1000 * (values[whole] - values[whole - 1])


def grouped(key, value=lambda r: r[1], rows=None):
    groups = defaultdict(list)
    for row in SAMPLES if rows is None else rows:
        groups[key(row)].append(value(row))
    return groups


def test_percentiles(log):
    expected = grouped(lambda r: r[2])
    for row in latency.percentiles(log, ["label"]).collect():
        for point, name in latency.PERCENTILES.items():
            assert row[name] == pytest.approx(legacy_percentile(expected[row.label], point))


def test_percentiles_span_boundaries(spark):
    values = [0, 1, 4095, 4096, 4097, 8191, 8192, 50_000, 2_000_000_000]
    log = spark.createDataFrame([sample(0, v, "x") for v in values for _ in range(v % 3 + 1)],
                                COLUMNS)
    flat = [v for v in values for _ in range(v % 3 + 1)]
    points = {p: f"p{p}" for p in range(0, 1001, 25)}
    row = latency.percentiles(log, ["label"], points).first()
    for p, name in points.items():
        assert row[name] == pytest.approx(legacy_percentile(flat, p))


def test_ranks_stay_exact_at_large_counts(spark):
    """Boundaries one sample off a percentile point, far beyond what six decimals resolve."""
    total = 10 ** 13
    sizes = [total // 2 - 1, 2, total // 2 - 1 - total // 100, total // 100]
    counts = spark.createDataFrame(
        [("x", value // ranks.SPAN, value, n) for value, n in zip((10, 20, 30, 40), sizes)],
        "label string, span bigint, value bigint, n bigint")
    ranked = ranks.rank_values(counts, ["label"])
    bounds = [sum(sizes[:i + 1]) for i in range(4)]

    def at(rank):
        return next(v for v, bound in zip((10, 20, 30, 40), bounds) if rank <= bound)

    points = [1, 499, 500, 501, 990, 999, 1000]
    found = {r.point: r.value for r in ranks.interpolated(ranked, ["label"], points).collect()}
    for p in points:
        whole, rest = divmod(p * (total + 1), 1000)
        low = at(min(max(whole, 1), total))
        high = at(min(whole + 1, total))
        assert found[p] == low + rest / 1000 * (high - low)
    curve = {r.point: r.value for r in ranks.stepped(ranked, ["label"]).collect()}
    assert curve == {k: at(min(k * total // 1000 + 1, total)) for k in range(1001)}


def test_published_interpolation(spark):
    """With 500 samples the 99th percentile lies 0.99 between ranks 495 and 496."""
    values = [1] * 494 + [49, 50, 51, 52, 53, 54]
    log = spark.createDataFrame([sample(0, v, "x") for v in values], COLUMNS)
    assert latency.percentiles(log, ["label"]).first().p99 == pytest.approx(49.99)


def test_percentile_curve(log):
    expected = grouped(lambda r: r[2])
    rows = latency.percentile_curve(log).collect()
    assert len(rows) == 1001 * len(expected)
    for row in rows:
        values = sorted(expected[row.label])
        rank = min(round(row.percentile * 10) * len(values) // 1000 + 1, len(values))
        assert row.elapsed == values[rank - 1]


def test_rollup_rounds_as_python_does(log):
    expected = grouped(lambda r: r[2], lambda r: r)
    for row in latency.rollup(log).collect():
        rows = expected[row.label]
        total, errors = sum(r[1] for r in rows), sum(r[6].lower() == "false" for r in rows)
        assert (row.samples, row.total_ms, row.errors) == (len(rows), total, errors)
        assert (row.min_ms, row.max_ms) == (min(r[1] for r in rows), max(r[1] for r in rows))
        assert row.avg_ms == round(total / len(rows), 1)
        assert row.error_pct == round(errors / len(rows) * 100, 1)
        assert row.busy_rate == round(len(rows) / (total / 1000), 2)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.one_of(
    st.integers(0, 10 ** 9).map(lambda n: n / 20), st.integers(0, 10 ** 9).map(lambda n: n / 8),
    st.integers(0, 10 ** 7).map(lambda n: n / 500), st.floats(0, 1e9)), min_size=200, max_size=400))
def test_rounding_equals_python(spark, numbers):
    df = spark.createDataFrame([(n,) for n in numbers], "x double")
    for row in df.select("x", round_binary(F.col("x"), 1).alias("one"),
                         round_binary(F.col("x"), 2).alias("two")).collect():
        assert (row.one, row.two) == (round(row.x, 1), round(row.x, 2))


def test_zero_elapsed_has_no_rate(spark):
    row = latency.rollup(spark.createDataFrame([sample(0, 0, "z")], COLUMNS)).first()
    assert (row.avg_ms, row.busy_rate, row.error_pct) == (0.0, 0.0, 0.0)


def test_published_busy_rate(spark):
    """500 samples over 1746 ms are 286.37 per busy second."""
    log = spark.createDataFrame([sample(0, 3, "k")] * 499 + [sample(0, 249, "k")], COLUMNS)
    row = latency.rollup(log).first()
    assert (row.total_ms, row.avg_ms, row.busy_rate) == (1746, 3.5, 286.37)


def test_totals(log):
    rows = {r.label: r for r in latency.statistics(log).collect()}
    assert rows["Total"].samples == len(SAMPLES)
    span = (max(r[0] + r[1] for r in SAMPLES) - min(r[0] for r in SAMPLES)) / 1000
    assert rows["Total"].wall_rate == pytest.approx(len(SAMPLES) / span)
    assert rows["Total"].received_kb_rate == pytest.approx(sum(r[7] for r in SAMPLES) / 1024 / span)
    assert rows["Total"].p95 == pytest.approx(legacy_percentile([r[1] for r in SAMPLES], 950))
    assert rows["lonely"].wall_rate == pytest.approx(1 / 0.042)


def test_a_label_called_total_stays_apart(spark):
    log = spark.createDataFrame([sample(0, 5, "Total"), sample(0, 7, "x")], COLUMNS)
    rows = {(r.label, r.is_total): r.samples for r in latency.statistics(log).collect()}
    assert rows == {("Total", 0): 1, ("x", 0): 1, ("Total", 1): 2}


def test_apdex_and_bands(log):
    good = sum(r[6] == "true" and r[1] <= 500 for r in SAMPLES)
    fair = sum(r[6] == "true" and 500 < r[1] <= 1500 for r in SAMPLES)
    slow = sum(r[6] == "true" and r[1] > 1500 for r in SAMPLES)
    total = {r.label: r for r in latency.apdex(log).collect()}["Total"]
    assert total.apdex == pytest.approx((good + fair / 2) / len(SAMPLES))
    counts = [r.samples for r in sorted(latency.bands(log).collect())]
    assert counts == [good, fair, slow, len(SAMPLES) - good - fair - slow]


def test_published_apdex(spark):
    values = [100] * 7491 + [1000] * 4 + [2000] * 6
    log = spark.createDataFrame([sample(0, v, "x") for v in values], COLUMNS)
    total = latency.apdex(log).where("is_total = 1").first()
    assert total.apdex == pytest.approx(0.9989334755365952)
    assert [r.samples for r in sorted(latency.bands(log).collect())] == [7491, 4, 6, 0]


def test_errors(log):
    kinds = {r.error: r for r in latency.error_types(log).collect()}
    failures = [r for r in SAMPLES if r[6].lower() == "false"]
    for code in ("500", "502"):
        count = sum(r[3] == code for r in failures)
        row = kinds[f"{code}/broken"]
        assert row.errors == count
        assert row.pct_of_errors == pytest.approx(100 * count / len(failures))
        assert row.pct_of_samples == pytest.approx(100 * count / len(SAMPLES))
    for row in latency.top_errors(log, 1).collect():
        counts = grouped(lambda r: r[3], rows=[r for r in failures if r[2] == row.label])
        assert row.errors == max(map(len, counts.values()))


def test_series_bucket_by_start_or_end(spark):
    log = spark.createDataFrame([sample(59_990, 20, "x"), sample(60_000, 1, "x", "false", "500")],
                                COLUMNS)
    assert sorted(map(tuple, latency.hits_over_time(log).collect())) == [
        (0, 1 / 60), (60_000, 1 / 60)]
    assert sorted(map(tuple, latency.total_over_time(log).collect())) == [
        (False, 60_000, 1 / 60), (True, 60_000, 1 / 60)]
    assert latency.means_over_time(log).first().mean_elapsed == 10.5
    assert latency.percentiles_over_time(log).first().max_ms == 20
    assert sorted(r.rate for r in latency.codes_over_time(log).collect()) == [1 / 60] * 2
    assert latency.transactions_over_time(log).count() == 2
    assert latency.bytes_over_time(log).first().received_rate == 210 / 60


def test_threads(spark):
    log = spark.createDataFrame([sample(0, 10, "x", threads=2, thread="Wide rows 1-2"),
                                 sample(0, 20, "x", threads=4, thread="Wide rows 1-13")], COLUMNS)
    assert latency.threads_over_time(log).first()[:] == ("Wide rows", 0, 3.0)
    assert sorted(map(tuple, latency.elapsed_by_threads(log).collect())) == [
        ("x", 2, 10.0), ("x", 4, 20.0)]
    assert latency.elapsed_by_mean_threads(log).first()[:] == ("x", 3.0, 15.0)


@pytest.mark.parametrize("value,index", [("elapsed", 1), ("latency", 11)])
def test_median_by_load(log, value, index):
    def bucket(row):
        return (row[0] + row[1]) // 10_000

    rates = {k: len(v) / 10 for k, v in grouped(bucket).items()}
    expected = grouped(lambda r: (rates[bucket(r)], r[6].lower() == "false"), lambda r: r[index])
    rows = latency.median_by_load(log, value, 10_000).collect()
    assert len(rows) == len(expected)
    for row in rows:
        median = legacy_percentile(expected[row.rate, row.failed], 500)
        assert row[f"median_{value}"] == pytest.approx(median)


def test_histogram_and_share(log):
    expected = {k: len(v) for k, v in grouped(lambda r: (r[2], r[1] // 100 * 100)).items()}
    assert {(r.label, r.from_ms): r.samples for r in latency.histogram(log).collect()} == expected
    share = latency.outcome_share(log).first()
    assert share.ok_pct + share.ko_pct == pytest.approx(100)


def test_log_columns_are_matched_by_name(spark, tmp_path):
    path = tmp_path / "log.csv"
    path.write_text("success,label,elapsed,extra\ntrue,a,12,x\nFALSE,,7,y\n,b,,z\n")
    rows = {r.label: r for r in read_log(spark, str(path)).collect()}
    assert (rows["a"].elapsed, rows["a"].success, rows["a"].start_ms) == (12, "true", None)
    assert (rows[""].elapsed, rows[""].success) == (7, "FALSE")
    assert (rows["b"].elapsed, rows["b"].success) == (0, "true")
    stats = {r.label: r for r in latency.rollup(read_log(spark, str(path))).collect()}
    assert stats[""].errors == 1


def test_a_log_may_be_many_files(spark, tmp_path):
    for name in "ab":
        (tmp_path / f"{name}.csv").write_text(f"label,elapsed\n{name},1\n")
    assert read_log(spark, f"{tmp_path}/*.csv").count() == 2
    assert read_log(spark, f"{tmp_path}/*.gone").count() == 0


def test_missing_log_is_empty(spark, tmp_path, caplog):
    log = read_log(spark, str(tmp_path / "none.csv"))
    assert "not found" in caplog.text
    assert latency.rollup(log).count() == 0
    assert latency.percentiles(log, ["label"]).count() == 0
    assert latency.outcome_share(log).first().ok_pct == 0
    compared = compare.compare(latency.rollup(log), compare.catalogue(spark)).collect()
    assert len(compared) == 15 and not any(r.has_data or r.is_best for r in compared)


def test_conform_needs_no_column(spark):
    row = conform_log(spark.createDataFrame([("x",)], "other string")).first()
    assert (row.label, row.elapsed, row.success) == ("", 0, "true")


def test_comparison_marks_ties_and_single_systems(spark):
    queries = compare.catalogue(spark, [
        ("Q1", "t", "A", "a", False), ("Q1", "t", "B", "b", False), ("Q1", "t", "C", "c", False),
        ("Q2", "t", "A", "alone", False), ("Q2", "t", "B", "gone", False),
        ("Q3", "t", "A", "d", False), ("Q3", "t", "B", "e", True)])
    rows = [sample(0, 10, "a"), sample(0, 10, "b"), sample(0, 1000, "c"), sample(0, 0, "alone"),
            sample(0, 4, "d"), sample(0, 4, "e"), sample(0, 1, "unlisted")]
    found = {r.label: r for r in compare.compare(
        latency.rollup(spark.createDataFrame(rows, COLUMNS)), queries).collect()}
    assert len(found) == 7
    assert [found[x].is_best for x in "abc"] == [True, True, False]
    assert [found[x].is_worst for x in "abc"] == [False, False, True]
    assert [found[x].scale_pct for x in "abc"] == [2.0, 2.0, 100.0]
    assert not found["alone"].is_best and found["alone"].scale_pct == 2.0
    assert not found["gone"].has_data and found["gone"].scale_pct is None
    assert found["d"].is_best and found["e"].is_best and not found["e"].is_worst


def test_catalogue_has_fifteen_queries(spark):
    rows = compare.catalogue(spark).collect()
    assert len(rows) == 15 and len({r.label for r in rows}) == 15
    assert sum(r.differs for r in rows) == 2


def test_from_log_to_report(spark, tmp_path):
    """Quotes, commas and line breaks inside a message, and a label of the catalogue."""
    from reshelve.schema import CATALOGUE
    label = CATALOGUE[0][3]
    path = tmp_path / "log.csv"
    path.write_text('timeStamp,elapsed,label,responseMessage,success\n'
                    f'1000,40,{label},"said ""no"", and\nleft",false\n1500,60,{label},OK,true\n')
    read = read_log(spark, str(path)).orderBy("start_ms").collect()
    assert [r.response_message for r in read] == ['said "no", and\nleft', "OK"]
    assert [r.success for r in read] == ["false", "true"]
    compare.report(spark, str(path), f"{tmp_path}/report")
    rows = spark.read.csv(f"{tmp_path}/report", header=True).collect()
    assert len(rows) == len(CATALOGUE)
    assert [(r.label, r.samples, r.avg_ms) for r in rows if r.has_data == "true"] == [
        (label, "2", "50.0")]
