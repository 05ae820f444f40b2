from pyspark.sql import functions as F

from enrichkit.functions.records import null_to_empty, row_json, row_text
from enrichkit.functions.text import dns_fields
from enrichkit.operators.profile import value_counts

from enrichkit.functions import (
    cidr_end,
    cidr_prefix_len,
    cidr_start,
    clean_domain,
    dns_fields,
    first_domain,
    ipv4_to_long,
    long_to_ipv4,
    lower_columns,
    null_to_empty,
    pick_field,
    row_json,
    row_text,
)

SAMPLE_LINE = "Mar  3 04:05:06 resolver[17]: reply cdn.shop.example.org is 203.0.113.8"


def test_ipv4_to_long_valid_and_invalid(spark):
    df = spark.createDataFrame(
        [("1.1.4.4",), ("8.8.8.8",), ("0.0.0.0",), ("255.255.255.255",), ("256.1.1.1",), ("1.2.3",),
         ("1.2.3.4.5",), ("a.b.c.d",), ("",), (None,), (" 1.2.3.4",), ("::1",)],
        "ip string",
    )
    got = [r[0] for r in df.select(ipv4_to_long("ip")).collect()]
    assert got == [16843780, 134744072, 0, 4294967295] + [None] * 8


def test_long_to_ipv4_round_trip(spark):
    df = spark.range(0, 4294967296, 33554467).select(F.col("id").alias("n"))
    back = df.select("n", ipv4_to_long(long_to_ipv4("n")).alias("m"))
    assert back.where(F.col("n") != F.col("m")).count() == 0


def test_cidr_bounds(spark):
    df = spark.createDataFrame([("1.0.0.0/24",), ("10.1.2.3/8",), ("8.8.8.8/32",), ("0.0.0.0/0",), ("1.2.3.4/33",)], "n string")
    got = df.select(cidr_start("n"), cidr_end("n"), cidr_prefix_len("n")).collect()
    assert [tuple(r) for r in got] == [
        (16777216, 16777471, 24),
        (167772160, 184549375, 8),
        (134744072, 134744072, 32),
        (0, 4294967295, 0),
        (None, None, None),
    ]


def test_dns_fields_sample_line_without_leading_blank(spark):
    df = spark.createDataFrame([(SAMPLE_LINE,), ("not a dns line",), (None,)], "message string")
    got = df.select(*[c.alias(n) for n, c in dns_fields("message").items()]).collect()
    assert tuple(got[0]) == ("reply", "cdn.shop.example.org", "203.0.113.8")
    assert tuple(got[1]) == ("", "", "")
    assert tuple(got[2]) == (None, None, None)


def test_dns_fields_query_types(spark):
    lines = [
        "Jan 22 15:26:31 dnsmasq[1]: query[A] example.com from 10.0.0.1",
        "Jan 22 15:26:31 dnsmasq[1]: forwarded example.com to 8.8.8.8",
        "Jan 22 15:26:31 dnsmasq[1]: /etc/hosts localhost is 127.0.0.1",
    ]
    df = spark.createDataFrame([(x,) for x in lines], "message string")
    got = [tuple(r) for r in df.select(*dns_fields("message").values()).collect()]
    assert got == [
        ("query[A]", "example.com", "10.0.0.1"),
        ("forwarded", "example.com", "8.8.8.8"),
        ("/etc/hosts", "localhost", "127.0.0.1"),
    ]


def test_first_domain_and_tld_limit(spark):
    df = spark.createDataFrame(
        [("http://evil.example.com/x.php",), ("-",), ("nothing here",), ("a.b.museum",), ("host.technology",)], "t string"
    )
    got = [r[0] for r in df.select(first_domain("t")).collect()]
    assert got == ["evil.example.com", "", "", "a.b.museum", "host.technology"]
    # an explicit bound cuts longer ones
    shorter = [r[0] for r in df.select(first_domain("t", max_tld=6)).collect()]
    assert shorter[-1] == "host.techno"


def test_dns_lines_without_a_tail(spark):
    lines = ["Jan 1 d[1]: reply bad.example.com is", "Jan 1 d[1]: /etc/hosts bad.example.com <HOST> 1.2.3.4", "Jan 1 d[1]: reply x.org"]
    df = spark.createDataFrame([(x,) for x in lines], "message string")
    want = [("reply", "bad.example.com", ""), ("/etc/hosts", "bad.example.com", "<HOST> 1.2.3.4"), ("reply", "x.org", "")]
    for matched in (False, True):
        fields = dns_fields("message", assume_match=matched)
        assert [tuple(r) for r in df.select(*fields.values()).collect()] == want


def test_names_with_dots(spark):
    df = spark.createDataFrame([("1", None), ("1", "b")], "`a.b` string, `c``d` string")
    assert df.select(row_json(df)).first()[0] == '{"a.b":"1"}'
    assert df.select(row_text(df)).first()[0] == "[1,null]"
    assert null_to_empty(df).first()[1] == ""
    assert [tuple(r) for r in value_counts(df).collect()] == [("a.b", "1", 2)]


def test_clean_domain_fallback(spark):
    df = spark.createDataFrame([("-", "rev.example.org"), ("bad.example.net/a", "x.example.org"), ("-", "-")], "a string, b string")
    got = [r[0] for r in df.select(clean_domain("a", "b")).collect()]
    assert got == ["rev.example.org", "bad.example.net", ""]


def test_row_json_omits_or_keeps_nulls(spark):
    df = spark.createDataFrame([(1, "a", None)], "id bigint, s string, t string")
    assert df.select(row_json(df)).first()[0] == '{"id":1,"s":"a"}'
    assert df.select(row_json(df, ignore_null_fields=False)).first()[0] == '{"id":1,"s":"a","t":null}'


def test_row_text_styles(spark):
    df = spark.createDataFrame([("7", "plum", None)], "id string, pid string, deid string")
    assert df.select(row_text(df)).first()[0] == "[7,plum,null]"
    assert df.select(row_text(df, style="plain")).first()[0] == "7,plum,"


def test_null_to_empty_and_lower_columns(spark):
    df = spark.createDataFrame([(None, 1)], "Message string, N int")
    out = lower_columns(null_to_empty(df))
    assert out.columns == ["message", "n"]
    assert tuple(out.first()) == ("", 1)


def test_pick_field(spark):
    df = spark.createDataFrame([('{"k": 69, "z": "a"}',), ("{}",), ("junk",)], "props string")
    got = [r[0] for r in df.select(pick_field("props", "k", json_text=True)).collect()]
    assert got == ["69", None, None]


def test_normalize_lower_cases_both_sides(spark):
    from enrichkit.operators.blocklist import dns_alerts

    msgs = spark.createDataFrame([(1, "Jan 22 15:26:31 dnsmasq[1]: reply Evil.Example.COM is 1.2.3.4")], "event_id bigint, message string")
    listing = spark.createDataFrame(
        [("d", "EVIL.example.com/a", "-", "-", "x", "-", "0", "0", "-")],
        "date string, listed_domain string, ip string, reverse string, description string, registrant string, asn string, inactive string, country string",
    )
    assert dns_alerts(msgs, listing).count() == 0  # compared as given by default
    assert [r["domain"] for r in dns_alerts(msgs, listing, normalize=True).collect()] == ["evil.example.com"]


def test_one_search_fields_equal_three_regexp_extracts(spark):
    from enrichkit.functions.text import DNS_LINE_PATTERN

    lines = [
        SAMPLE_LINE,
        SAMPLE_LINE + "\n",
        SAMPLE_LINE + "\r\n",
        "a: b c d\te\tf",
        "x:y: reply host.example.com is 10.0.0.1:53 extra words",
        "Jan 22 15:26:31 dnsmasq[1]: query[AAAA] a.b from 10.0.0.1  ",
        "reply host is 1.2.3.4",
        "k:  t d w ",
        ":\t\tq\td\tw\t",
        "",
        None,
        "no colon here at all",
    ]
    from enrichkit.functions.text import dns_line_matches

    df = spark.createDataFrame([(x,) for x in lines], "message string").where(dns_line_matches("message"))
    fast = df.select(*[c.alias(n) for n, c in dns_fields("message", assume_match=True).items()]).collect()
    slow = df.select(*[F.regexp_extract("message", DNS_LINE_PATTERN, i) for i in (1, 2, 3)]).collect()
    assert len(fast) == 8
    assert [tuple(r) for r in fast] == [tuple(r) for r in slow]


def test_dns_lines_without_a_type_or_a_tail(spark):
    lines = {
        "d[1]:  a.example is 1.2.3.4": ("", "a.example", "1.2.3.4"),
        "d[1]:  a.example": ("", "a.example", ""),
        "d[1]: reply a.example": ("reply", "a.example", ""),
        "d[1]:   reply a.example is 1.2.3.4": ("reply", "a.example", "1.2.3.4"),
        "d[1]: a.example": ("", "", ""),
    }
    df = spark.createDataFrame([(x,) for x in lines], "message string")
    fields = dns_fields("message")
    got = {r.message: tuple(r)[1:] for r in df.select("message", *[c.alias(n) for n, c in fields.items()]).collect()}
    assert got == lines
    matched = df.where("message <> 'd[1]: a.example'")
    fields = dns_fields("message", assume_match=True)
    got = {r.message: tuple(r)[1:] for r in matched.select("message", *[c.alias(n) for n, c in fields.items()]).collect()}
    assert got == {k: v for k, v in lines.items() if v[1]}
