"""Hand-written lines, one per rule of the log format."""

import random
import re

import pytest
from pyspark.sql import functions as F

from logquarry.functions import clf
from logquarry.functions import patterns as P
from logquarry.operators import parse


def log(request="GET /a HTTP/1.0", status="200", size="10", time="01/Jul/1995:00:00:01 -0400",
        host="h1"):
    return f'{host} - - [{time}] "{request}" {status} {size}'


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


@pytest.mark.parametrize(
    "text, kind",
    [
        ("", "blank"),
        (" \t\x01\x1f ", "blank"),
        ("garbage", "malformed"),
        ("\t " + log() + "\t\x0b", "parsed"),
        (log() + "\r\n", "parsed"),
        (log(request='GET /a"b" HTTP/1.0'), "parsed"),
        (log(request=""), "parsed"),
        (log(status="20"), "malformed"),
        (log(status="2000"), "malformed"),
        (log(time=""), "malformed"),
        ('h1  -\t- [t]  "x"  200  5', "parsed"),
        (log() + " extra", "malformed"),
        ("a\nb\nc\nd\ne", "malformed"),
        ("only\nnoise", "malformed"),
    ],
)
def test_line_kind(lines_of, text, kind):
    assert one(parse.classify_lines(lines_of(text))).line_kind == kind


def test_fields(lines_of):
    row = one(parse.parse_lines(lines_of(log(request='GET /q?"x" HTTP/1.0', host="a_b"))))
    assert (row.host, row.log_time, row.request, row.status_code, row.bytes) == (
        "a_b",
        "01/Jul/1995:00:00:01 -0400",
        'GET /q?"x" HTTP/1.0',
        200,
        10,
    )
    assert (row.log_date, row.log_hour) == ("01/Jul/1995", 0)


@pytest.mark.parametrize(
    "size, expected",
    [("-", 0), ("abc", 0), ("-12", 0), ("12.5", 0), ("+5", 5), ("0", 0), ("1" * 20, 0),
     ("9223372036854775807", 9223372036854775807), ("9223372036854775808", 0)],
)
def test_bytes(lines_of, size, expected):
    assert one(parse.parse_lines(lines_of(log(size=size)))).bytes == expected


@pytest.mark.parametrize(
    "time, date, hour",
    [("01/Jul/1995:23:59:59 -0400", "01/Jul/1995", 23), ("01/Jul/1995", "01/Jul/1995", None),
     ("01/Jul/1995:", "01/Jul/1995", None), ("01/Jul/1995:xx:00", "01/Jul/1995", None),
     ("12", "12", None), (":07", "", 7)],
)
def test_date_and_hour(lines_of, time, date, hour):
    row = one(parse.parse_lines(lines_of(log(time=time))))
    assert (row.log_date, row.log_hour) == (date, hour)


@pytest.mark.parametrize(
    "request_text, expected",
    [
        ("GET /a HTTP/1.0", ("GET", "/a", "HTTP/1.0")),
        ("GET /a", ("GET", "/a", None)),
        ("get  /a\tHTTP/1.0", ("get", "/a", "HTTP/1.0")),
        ("GET", None),
        ("", None),
        ("GET /a b HTTP/1.0", None),
        (" GET /a", None),
    ],
)
def test_request_parse(lines_of, request_text, expected):
    rows = parse.parse_requests(parse.parse_lines(lines_of(log(request=request_text)))).collect()
    found = [(r.method, r.path, r.protocol) for r in rows]
    assert found == ([expected] if expected else [])


@pytest.mark.parametrize(
    "path, decoded, printable, raw",
    [
        ("/a", "/a", "/a", "/a"),
        ("/%7Ea", "/~a", "/%7Ea", "/%7Ea"),
        ("/a+b", "/a b", "/a+b", "/a+b"),
        ("/bad%zz", "/bad%zz", "/bad%zz", "/bad%zz"),
        ("/a%2", "/a%2", "/a%2", "/a%2"),
        ("/100%", "/100%", "/100%", "/100%"),
        ("/a%ff/b", "/a/b", "/a%ff/b", "/a%ff/b"),
        ("/é", "/", "/", "/é"),
        ("/a%0Ab", "/ab", "/a%0Ab", "/a%0Ab"),
        ("/a+", "/a", "/a+", "/a+"),
        ("%2Fa", "/a", None, None),
        ("é/a", "/a", None, None),
        ("noslash", None, None, None),
    ],
)
def test_resource_path(lines_of, path, decoded, printable, raw):
    parsed = parse.parse_lines(lines_of(log(request=f"GET {path} HTTP/1.0")))
    for mode, expected in (("decoded", decoded), ("printable", printable), ("raw", raw)):
        found = [r.resource_path for r in parse.filter_resources(parsed, mode).collect()]
        assert found == ([expected] if expected is not None else []), mode


@pytest.mark.parametrize("method, kept", [("GET", 1), ("POST", 1), ("HEAD", 1), ("PUT", 0), ("get", 0)])
def test_method_filter(lines_of, method, kept):
    parsed = parse.parse_lines(lines_of(log(request=f"{method} /a")))
    assert parse.filter_resources(parsed).count() == kept


@pytest.mark.parametrize(
    "status, usual, from_400", [(399, 0, 0), (400, 1, 1), (599, 1, 1), (600, 0, 1), (700, 0, 1)]
)
def test_error_modes(spark, status, usual, from_400):
    row = spark.range(1).select(
        clf.is_error(F.lit(status)).cast("int").alias("a"),
        clf.is_error(F.lit(status), "ge400").cast("int").alias("b"),
    ).first()
    assert (row.a, row.b) == (usual, from_400)


def test_unknown_modes_are_refused():
    with pytest.raises(ValueError):
        clf.is_error(F.lit(1), "other")
    with pytest.raises(ValueError):
        clf.clean_path(F.lit("/"), "other")


@pytest.mark.parametrize("length, shown", [(48, 48), (49, 48)])
def test_report_path(spark, length, shown):
    text = spark.range(1).select(clf.shorten_path(F.lit("/" + "a" * (length - 1)))).first()[0]
    assert len(text) == shown
    assert text.endswith("...") == (length > 48)


def test_strict_shapes(lines_of):
    fine, tabbed = log(), log().replace(" - - ", "\t-\t-\t")
    rows = parse.read_with_pattern(lines_of(fine, tabbed, " " + fine, ""), "strict_resources")
    found = [r.path for r in rows.collect()]
    assert found == ["/a", None, None, None]
    hours = parse.parse_strict(lines_of(fine, log(time="01/Jul/1995")), "strict_hourly").collect()
    assert [(r.log_date, r.log_hour) for r in hours] == [("01/Jul/1995", 0)]


def test_groups_match_a_plain_regex(lines_of):
    """The one-pass form against Python's regex on random near-miss lines."""
    rng = random.Random(7)
    pieces = ["h", "-", " ", "  ", "\t", "[", "]", '"', "200", "99", ":", "/", "GET", "\n", "x_y"]
    texts = ["".join(rng.choices(pieces, k=rng.randint(0, 14))) for _ in range(3000)]
    texts += [
        log(request="".join(rng.choices(pieces, k=4)), size=rng.choice(pieces)) for _ in range(3000)
    ]
    for pattern, names in P.READ_SHAPES.values():
        n = len(names)
        rows = (
            lines_of(*texts)
            .select("line", clf.match_groups(F.col("line"), pattern, n).alias("g"))
            .select("line", F.when(F.size("g") == n, F.col("g")).alias("g"))
            .collect()
        )
        # Java's $ and Python's agree on a final line feed; \Z would not.
        expected = [re.search(pattern, t, re.ASCII) for t in texts]
        assert [r.g for r in rows] == [list(m.groups()) if m else None for m in expected]


def test_plain_route_agrees_when_ansi_is_off(spark, lines_of):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        kinds = [
            r.line_kind
            for r in parse.classify_lines(lines_of(log(), "x\ny", "", log(size="abc"))).collect()
        ]
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")
    assert kinds == ["parsed", "malformed", "blank", "parsed"]
