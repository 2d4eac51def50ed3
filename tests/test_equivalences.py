"""Different routes to one result, hot keys, and bounded host sets."""

import pytest
from pyspark.sql import functions as F

from logquarry.functions import packed
from logquarry.operators import errors, parse, quality, resources, rollup, traffic
from logquarry.sources.corpus import corpus_lines


@pytest.fixture(scope="module")
def lines(spark, sf_dir):
    return corpus_lines(spark, sf_dir).persist()


@pytest.fixture(scope="module")
def parsed(lines):
    return parse.parse_lines(lines)


@pytest.fixture(scope="module")
def partials(parsed):
    return resources.resource_partials(parse.filter_resources(parsed)).persist()


def same(a, b):
    columns = sorted(a.columns)
    assert columns == sorted(b.columns)
    rows = [sorted(map(str, df.select(columns).collect())) for df in (a, b)]
    assert rows[0] == rows[1] and rows[0]


def test_resource_routes_agree(parsed, partials):
    direct = resources.resource_totals(parse.filter_resources(parsed))
    same(direct, resources.merge_partials(partials))
    sets = resources.host_set_partials(partials)
    same(direct, resources.merge_host_sets(sets))
    packed_sets = packed.decode_host_sets(packed.encode_host_sets(sets))
    same(direct, resources.merge_host_sets(packed_sets))
    same(resources.top_resources(direct), resources.merge_top_resources(partials))
    same(resources.top_resources(direct, 7), resources.merge_top_resources(partials, 7))


@pytest.mark.parametrize("digits", [1, 2, 3])
def test_host_sets_stay_bounded_and_whole(parsed, partials, digits):
    direct = resources.resource_totals(parse.filter_resources(parsed))
    sets = resources.host_set_partials(partials, digits)
    same(direct, resources.merge_host_sets(sets))
    parts = sets.groupBy("batch_id", "resource_path").agg(F.count("*").alias("n"))
    assert parts.agg(F.max("n")).first()[0] > 1
    union = resources.union_host_sets(sets, digits)
    counted = union.groupBy("resource_path").agg(F.sum("host_count").alias("distinct_hosts"))
    same(direct.select("resource_path", "distinct_hosts"), counted)
    hosts = sets.select("host_part", F.explode(F.split("hosts", "#")).alias("host"))
    assert hosts.filter(F.substring(F.md5("host"), 1, digits) != F.col("host_part")).count() == 0


def test_hourly_routes_agree(parsed):
    same(errors.hourly_errors(parsed), errors.hourly_errors_two_phase(parsed))


def test_batches_add_up(parsed):
    per_batch = traffic.daily_status(parsed, by_batch=True)
    same(traffic.daily_status(parsed), traffic.roll_up_daily(per_batch))


def test_byte_branches_union(parsed):
    """One CASE over one scan equals the union of one filtered copy per branch."""
    tagged = parse.tag_byte_branches(parsed)
    text = F.col("bytes_text")
    number = text.try_cast("bigint")
    branches = [
        parsed.filter(text == "-").withColumn("bytes", F.lit(0).cast("bigint")),
        parsed.filter(text == "").withColumn("bytes", F.lit(0).cast("bigint")),
        parsed.filter(number >= 0).withColumn("bytes", number),
        parsed.filter((text != "-") & (text != "") & ~F.coalesce(number >= 0, F.lit(False)))
        .withColumn("bytes", F.lit(0).cast("bigint")),
    ]
    union = branches[0]
    for branch in branches[1:]:
        union = union.unionByName(branch)
    same(traffic.daily_status(tagged), traffic.daily_status(union))
    assert {r[0] for r in tagged.select("byte_branch").distinct().collect()} == {
        "dash", "valid", "other"
    }


@pytest.mark.parametrize("questions", [("Q1",), ("Q2",), ("Q3",), ("Q1", "Q3"), ("Q1", "Q2", "Q3")])
def test_rollup_gives_every_result(lines, parsed, partials, questions):
    stored = rollup.partials(lines, questions).persist()
    same(quality.parse_quality(lines), rollup.quality_of(stored))
    if "Q1" in questions:
        same(traffic.daily_status(parsed, by_batch=True), rollup.daily_of(stored))
    if "Q2" in questions:
        same(partials, rollup.resource_rows_of(stored))
    if "Q3" in questions:
        same(errors.hourly_errors(parsed, by_batch=True), rollup.hourly_of(stored))
        same(errors.hourly_errors(parsed), rollup.hourly_of(stored, by_batch=False))
    stored.unpersist()


def test_packed_round_trip(parsed):
    daily = traffic.daily_status(parsed)
    same(daily, packed.decode_daily(packed.encode_daily(daily)).drop("_corrupt"))
    totals = resources.resource_totals(parse.filter_resources(parsed))
    same(totals, packed.decode_resources(packed.encode_resources(totals)).drop("_corrupt"))
    hourly = errors.hourly_errors(parsed).drop("error_rate_raw")
    same(hourly, packed.decode_hourly(packed.encode_hourly(hourly)).drop("_corrupt"))


@pytest.mark.parametrize(
    "decode, key, value",
    [
        (packed.decode_daily, "01/Jul/1995", "1_2"),
        (packed.decode_daily, "01/Jul/1995_2xx", "1_2"),
        (packed.decode_daily, "01/Jul/1995_200", "1"),
        (packed.decode_resources, "/a", "1_2"),
        (packed.decode_resources, "", "1_2_3"),
        (packed.decode_resources, "/a", "1_x_3"),
        (packed.decode_hourly, "01/Jul/1995_1", "1_2_3"),
        (packed.decode_hourly, None, "1_2_0.5_3"),
        (packed.decode_hourly, "01/Jul/1995_1", None),
    ],
)
def test_damaged_packed_rows_are_kept(spark, decode, key, value):
    df = spark.createDataFrame([(key, value)], "packed_key string, packed_value string")
    row = decode(df).first()
    assert row["_corrupt"] == "\t".join(x for x in (key, value) if x is not None)
    assert all(row[c] is None for c in row.asDict() if c != "_corrupt")


def test_hot_path_and_hour(spark):
    """A third of all requests on one path in one hour, each from its own host."""
    lines = spark.range(3000).select(
        F.lit(1).alias("batch_id"),
        F.format_string(
            'h%d - - [01/Jul/1995:%02d:00:00 -0400] "GET %s HTTP/1.0" %d 1',
            "id",
            F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id") % 24),
            F.when(F.col("id") % 3 == 0, F.lit("/hot")).otherwise(F.concat(F.lit("/p"), F.col("id") % 50)),
            F.when(F.col("id") % 2 == 0, 404).otherwise(200),
        ).alias("line"),
    )
    parsed = parse.parse_lines(lines)
    partials = resources.resource_partials(parse.filter_resources(parsed))
    top = resources.merge_top_resources(partials).first()
    assert (top.resource_path, top.request_count, top.distinct_hosts) == ("/hot", 1000, 1000)
    sets = resources.host_set_partials(partials, digits=1)
    hot = sets.filter("resource_path = '/hot'").select(F.size(F.split("hosts", "#")).alias("n"))
    sizes = [r.n for r in hot.collect()]
    assert sum(sizes) == 1000 and len(sizes) == 16 and max(sizes) < 200
    hour = errors.hourly_errors(parsed).filter("log_hour = 5").first()
    assert hour.distinct_error_hosts == hour.error_request_count >= 500


def test_counts_at_a_hundredth(spark):
    """Corpus counts worked out by hand from the rules that derive it."""
    lines = corpus_lines(spark, "/root/testdata/sf0.01")
    total = quality.parse_quality(lines).agg(
        *[F.sum(c) for c in ("total_lines", "blank_lines", "malformed", "records_processed")]
    ).first()
    assert tuple(total) == (10_000, 150, 138, 9_712)
    parsed = parse.parse_lines(lines)
    requests = parse.filter_resources(parsed)
    assert requests.count() == 9_077
    assert requests.select("resource_path").distinct().count() == 296
    assert traffic.daily_status(parsed).count() == 150
    assert errors.hourly_errors(parsed).count() == 720
