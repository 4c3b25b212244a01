import pytest
from pyspark.sql import functions as F

from shelfdiff.functions import text, values
from shelfdiff.functions import weeks as W


def check(spark, fn, cases, kind="string"):
    """``fn(column)`` over the inputs of ``cases`` [(input, expected)] in one job."""
    rows = [(i, given) for i, (given, _want) in enumerate(cases)]
    df = spark.createDataFrame(rows, f"i int, x {kind}").select("i", fn(F.col("x")).alias("y"))
    got = [r.y for r in sorted(df.collect(), key=lambda r: r.i)]
    assert got == [want for _given, want in cases]


def test_week_of_uses_the_iso_year(spark):
    check(spark, lambda c: W.week_of(c.cast("date")), [
        ("2025-12-29", "2026-W01"), ("2026-12-28", "2026-W53"), ("2027-01-03", "2026-W53"),
        ("2027-01-04", "2027-W01"), (None, None)])


def test_weeks_that_do_not_exist(spark):
    check(spark, W.is_valid_week, [
        ("2026-W", False), ("2026W33", False), ("26-W33", False), ("2026-W00", False),
        ("2026-W54", False), ("", False), ("2025-W53", False), ("2026-W53", True),
        ("2026-W01\n", False), (None, False)])


def test_shift_and_gap_cross_years(spark):
    check(spark, lambda c: W.shift_week(c, -1), [("2026-W01", "2025-W52"), ("2027-W01", "2026-W53"),
                                                  ("nonsense", None)])
    check(spark, lambda c: W.week_gap(c, F.lit("2026-W01")), [("2025-W52", 1), ("2025-W51", 2)])
    check(spark, lambda c: W.monday_of(c).cast("string"), [("2026-W01", "2025-12-29")])


def test_normalize_name(spark):
    check(spark, text.normalize_name, [
        ("ＡＢＣ　ﾊﾝ", "abc ハン"), (" A\x1c B\t c ", "a b c"), ("샐)오리지널", "샐)오리지널"),
        ("빅맥®", "빅맥®"), ("㈜한국", "(주)한국"), ("ÀÉ ß", "àé ß"), (None, None)])


def test_prefix_is_split_for_display_only(spark):
    check(spark, lambda c: F.concat_ws("|", F.coalesce(text.split_pos_prefix(c)["prefix"], F.lit("-")),
                                       text.split_pos_prefix(c)["rest"]), [
        ("샐)오리지널닭가슴살샐러", "샐|오리지널닭가슴살샐러"), ("빅삼) 참치", "빅삼|참치"),
        ("너무길다란)이름", "-|너무길다란)이름"), ("이름", "-|이름")])


def test_similarity_of_short_names(spark):
    one = "가나다라마바사아자차카타"
    df = spark.createDataFrame([(one, one[:-1] + "X"), (one, one[:-2] + "XY"), ("", "")], "a string, b string")
    a, b, c = [r.s for r in df.select(text.similarity("a", "b").alias("s")).collect()]
    assert 0.91 < a < 0.92 and b < 0.85 and c == 1.0


def test_entities_and_markup(spark):
    check(spark, text.unescape, [("&amp;lt;", "&lt;"), ("a&nbsp;b", "a b"), ("&copy; &#8361;", "© ₩"),
                                 ("R&D", "R&D"), ("&quot;&#39;&lt;&gt;", "\"'<>")])
    check(spark, text.clean_text, [("  a \r\n &nbsp; b ", "a b"), ("  ", None), (None, None)])
    check(spark, text.strip_markup, [("빅맥<sub class=reg>®</sub> 세트", "빅맥 ® 세트"),
                                     ("매콤<br>\r\n크림", "매콤 크림"), ("<br>", None)])


def test_entities_cut_before_their_semicolon(spark):
    cut = [("a &copy; b&amp", "a © b&amp"), ("&copy &#65; &#65", "&copy A &#65"), ("&notanentity; &copy;", "&notanentity; ©"),
           ("&amp;lt; &middot;", "&lt; ·")]
    check(spark, lambda c: text.unescape(c, closed=True), cut)
    check(spark, lambda c: text.clean_text(c, closed=True), [(" a  &copy;&amp ", "a ©&amp")])
    check(spark, lambda c: text.strip_markup(c, closed=True), [("<p>a &middot; b&amp</p>", "a · b&amp")])
    check(spark, text.unescape, [("a &copy; b&amp", "a © b&")])


def test_small_text_functions(spark):
    check(spark, text.clean_episode_suffix, [("혜자)도시락1편", "혜자)도시락"), ("도시락3편", "도시락3편"), ("2편 ", "")])
    check(spark, lambda c: F.array_join(text.hashtags(c), "|"), [("#크림 #조청 ##", "크림|조청"), ("", ""), (None, "")])
    check(spark, text.search_normalize, [("A b　C﻿", "abc")])
    check(spark, text.strip_fence, [("```json\n[1]\n```", "[1]"), (" [1] ", "[1]"), ("```\na ``` b\n```\n", "a ``` b"),
                                    ("```json\n[1]", "[1]")])
    check(spark, lambda c: text.clip_text(c, 3), [(" abc ", "abc"), ("abcd", "abc\n… (총 4자, 이하 생략)")])
    check(spark, lambda c: text.clip_text(c, 1), [("x" * 1234, "x\n… (총 1,234자, 이하 생략)")])
    check(spark, lambda c: text.clip_blurb(c, 2), [("🍔🍔🍔", "🍔🍔")])
    check(spark, lambda c: text.category_path(c, F.lit(" b ")), [(" a ", "a > b"), (None, " > b")])


@pytest.mark.parametrize("kind,cases", [
    ("yes", [("Y", True), (" y ", True), ("N", False), (None, False)]),
    ("exact_t", [("T", True), ("t", False), (None, False)]),
    ("visible", [("color:red", True), ("opacity: 0", False), (None, False)]),
    ("new_prefix", [("[NEW]치킨", True), ("치킨[NEW]", False)]),
    ("present", [("icon.png", True), ("  ", False), (None, False)]),
])
def test_flags(spark, kind, cases):
    check(spark, lambda c: text.flag(c, kind), cases)


def test_prices(spark):
    check(spark, values.price_digits, [("1,200", 1200), (" 700 ", 700), ("1,200원", None), ("", None), (None, None)])
    check(spark, values.price_search, [("L 36,900원~", 36900), ("무료", None), (None, None)])
    check(spark, values.price_float, [("5500.0", 5500), ("0", None), ("", None), (None, None)])
    check(spark, values.price_lowest, [([0.0, 5.5, None, 7.0], 5), ([], None), ([-1.0], None)], "array<double>")
    check(spark, lambda c: values.price_by_size(c), [({"L": 3, "M": 2}, 2), ({"?": 1, "L": 3}, 3), ({"?": 1}, 1), ({}, None)],
          "map<string,int>")


def test_keys(spark):
    check(spark, values.barcode_from_url, [("https://x/8809655892303_1.jpg", "8809655892303"), ("/abc_1.jpg", None),
                                           ("/1234567.jpg", None), (None, None)])
    check(spark, values.barcode_from_path, [("/500/8800323762973.JPG", "8800323762973"), ("/8800323762973_1.JPG", None)])
    check(spark, values.sequence_from_code, [("RPPZ2275", 2275), ("RPPX2275", None), ("RPPZ22A", None), ("RPPZ", None)])
    check(spark, values.name_hash, [("가", "nh" + __import__("hashlib").sha1("가".encode()).hexdigest()[:12])])
    check(spark, lambda c: values.surrogate_key(c, name=F.lit("n"), prefix="p").substr(1, 2), [("7", "p7"), ("", "nh"), (None, "nh")])


def test_urls(spark):
    check(spark, lambda c: values.absolutize(c, "https://b"), [("//x/y", "https://x/y"), ("http://z", "http://z"),
                                                               ("/p", "https://b/p"), ("", None), (None, None)])
    check(spark, values.percent_encode, [("/a b/한*~.png", "/a%20b/%ED%95%9C%2A~.png")])
    check(spark, values.percent_decode, [("%ed%95%ab+x", "핫+x")])
    check(spark, values.css_url, [("background-image: url( '/a b.png')", "/a b.png"), ("color:red", None)])
    check(spark, values.real_image, [("a.png", "a.png"), ("x/null", None), ("", None)])
    check(spark, lambda c: values.conditional_image(c, F.lit("7"), "i/%s"), [("Y", "i/7"), ("N", None), (None, None)])
    check(spark, lambda c: values.template_url("u/%s", c, fallback=F.lit("list")), [("1", "u/1"), (None, "list")])
    check(spark, values.format_price, [(1234567, "1,234,567원"), (None, None)], "bigint")
