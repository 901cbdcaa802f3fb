import html
import re
import urllib.parse

import pytest
from conftest import plan_of
from conftest import plan_of
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from framesift.functions import captions, cleaning
from framesift.operators import captions as ops
from framesift.operators import language


def apply(spark, texts, fn):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    return [r["o"] for r in df.select("i", fn(F.col("text")).alias("o")).orderBy("i").collect()]


def test_prefixes_in_both_cases(spark):
    for prefix in captions.CAPTION_PREFIXES:
        texts = [f"{prefix} a dog.", f"{prefix.lower()}\n a dog.", prefix, f"x {prefix} a dog."]
        want = ["A dog.", "A dog.", "", f"x {prefix} a dog."]
        assert apply(spark, texts, captions.strip_caption_prefix) == want, prefix


def test_only_the_first_prefix_goes(spark):
    assert apply(spark, ["The video shows the video shows a cat", None, "The Video shows"], captions.strip_caption_prefix) == [
        "The video shows a cat",
        None,
        "The Video shows",
    ]


def test_unmapped_motion(spark):
    df = spark.createDataFrame([("a", "pan left"), ("b", "unknown")], "text string, cmotion string")
    kept = df.select(captions.merge_camera_motion(F.col("text"), F.col("cmotion"), "keep").alias("o")).collect()
    assert [r["o"] for r in kept] == ["a Camera motion: pan left.", "b"]
    with pytest.raises(PySparkException):
        df.select(captions.merge_camera_motion(F.col("text"), F.col("cmotion"))).collect()


def test_one_decimal_rounds_as_printf(spark):
    values = [0.25, 5.25, 5.35, 0.05, 0.15, 0.95, 9.95, 9.96, 2.5, 1e-9, 123456.75, 0.0, -0.25, -3.35, 99.949999999]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert [r["o"] for r in df.select(captions.fixed1(F.col("v")).alias("o")).collect()] == [f"{v:.1f}" for v in values]


def test_score_text_drops_a_fifth(spark):
    df = spark.range(5000).select(F.col("id").alias("pos"), F.lit("t").alias("text"), F.lit(5.0).alias("aes"), F.lit(1.5).alias("flow"))
    out = ops.add_scores_to_text(df, seed=1)
    counts = {r["text"]: r["count"] / 5000 for r in out.groupBy("text").count().collect()}
    assert abs(counts["t [aesthetic score: 5.0, motion score: 1.5]"] - 0.64) < 0.03
    assert abs(counts["t"] - 0.04) < 0.01


def test_score_text_without_columns(spark):
    df = spark.createDataFrame([(1, "t", 2.0)], "pos int, text string, flow double")
    assert ops.add_scores_to_text(df, drop=-1).first()["text"] == "t [motion score: 2.0]"


def test_brackets(spark):
    texts = ["[a, b] and [c]", "none", "[a", "a]", "[]", "[ ]", "[a\nb]", None, "]x[y]"]
    bad = captions.NONE_FOUND
    assert apply(spark, texts, captions.parse_bracket_tags) == ["a, b", bad, bad, bad, bad, bad, bad, bad, bad]
    compat = lambda c: captions.parse_bracket_tags(c, compat=True)

    def sliced(s):
        body = s[s.find("[") + 1 : s.find("]")]
        return bad if "\n" in body or not body.strip() else body

    assert apply(spark, [t for t in texts if t], compat) == [sliced(t) for t in texts if t]


def test_template_must_fit(spark):
    templates = spark.createDataFrame([("video", "Describe.", "video")], "key string, template string, type string")
    df = spark.createDataFrame([("a", "image")], "text string, kind string")
    with pytest.raises(PySparkException):
        ops.with_prompts(df, templates, F.lit("video"), F.col("kind")).collect()


TEXTS = [
    "Plain caption of a cat.",
    "see https://a.b.com/x?y=1 and www.site.org/page now",
    "mail me at jane.doe@site.com or site.co@x",
    "100% cotton %41%20b%C3%A9 a+b %zz 50% off",
    "<b>Bold</b> &amp; <i>it</i> &lt;tag&gt; &eacute;t&eacute; 1 < 2",
    "<person> walks, <PERSON> runs <script>var x = '</b>';</script>done",
    "@nick_name hello @ü tail",
    "中文字符 mixed ㆀ with 漢字 text",
    "dash — – ‒ − ― word",
    "«quote» “double” ‘single’ `tick´ \"\"more\"\" ''x''",
    "&quot;a&quot b &ampc",
    "at 10.0.0.1 or 192.168.100.200 12:30   ",
    "line\\nbreak and real\nbreak",
    "#12 #123 #1234 #12345 123456 1234567 12345",
    "file photo.png and a.b.jpeg movie.mp4x",
    "dots... and .. end . next",
    "***AUSVERKAUFT*** (x) [y] {z} a|b c/d e\\f ~ § ½",
    "this-is-my-cute-cat and_more",
    "this-is-my cat",
    "jc6640 jc6640vc 6640vc231 j2d1a2a ab12",
    "free shipping worldwide free shipping shipping download free download",
    "click for more click on this pdf images page 12",
    "size 12x30 1.5x2 3х4 5×6",
    "word : other ,tight.dots,here/there",
    "\"whole thing quoted\"",
    "'single quoted'",
    ":starts with colon",
    "ends with dash-",
    ".onlydots",
    "ünïcode wörds, mit.Punkt,und 3é4 é123456 123456é",
    "  spaces   everywhere 　",
    "cafÃ© mojibake &amp;amp; twice",
    "",
]


def twin(text):
    """The recipe with Python's own regular expressions."""

    def subs(text, steps):
        for pattern, replacement in steps:
            text = re.sub(pattern, replacement.replace("$1", r"\1"), text)
        return text

    text = urllib.parse.unquote_plus(text).strip().lower().replace("<person>", "person")
    text = subs(text, [(p, "") for p in cleaning.URL_PATTERNS])
    text = cleaning.markup_text(text)
    text = subs(text, [(cleaning.NICKNAME, ""), (cleaning.CJK, ""), (cleaning.DASHES, "-")])
    for c in cleaning.DOUBLE_QUOTES:
        text = text.replace(c, '"')
    for c in cleaning.SINGLE_QUOTES:
        text = text.replace(c, "'")
    text = subs(text, [*cleaning.ENTITY_RESIDUE, (cleaning.IP_ADDRESS, " "), (cleaning.ARTICLE_TIME, "")]).replace("\\n", " ")
    text = subs(text, cleaning.NUMBERS_AND_FILES + cleaning.PUNCTUATION)
    if len(re.findall("[-_]", text)) > 3:
        text = re.sub("[-_]", " ", text)
    text = cleaning.repair_text(text).strip()
    return subs(text, cleaning.SHOP_AND_ID_WORDS + cleaning.SPACING_AND_EDGES).strip()


def test_cleaning_matches_python_regular_expressions(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "i int, text string")
    got = [r["text"] for r in ops.clean_caption(df).orderBy("i").collect()]
    assert got == [twin(twin(t)) for t in TEXTS]


def test_cleaning_keeps_missing_captions(spark):
    df = spark.createDataFrame([(1, None)], "i int, text string")
    assert ops.clean_caption(df).first()["text"] is None


def test_cleaning_goldens(spark):
    texts = ["<p>A &amp; B</p>", "AUSVERKAUFT!!! http://x.com/abc", "“Hi”", "a%20b"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    got = [r["text"] for r in ops.clean_caption(df).orderBy("i").collect()]
    assert got == ["a b", "ausverkauft!!!", "hi", "a b"]


def test_markup():
    assert cleaning.markup_text("a<br>b<!-- c --><style>p{}</style>&nbsp;d &unknown; <1") == "ab\xa0d &unknown; <1"
    assert cleaning.repair_text("cafÃ© ‘x’ &amp;lt;") == "café 'x' <"
    assert html.unescape("&amp;") == "&"


def test_cleaning_steps_are_not_copied_in_the_plan(spark):
    df = spark.createDataFrame([(1, "x")], "i int, text string")
    text = plan_of(ops.clean_caption(df))
    assert text.count("regexp_replace(") < 100


def test_token_counters(spark):
    df = spark.createDataFrame([("a  b c",), ("",), (None,)], "text string")
    assert [r["text_len_ws"] for r in ops.count_tokens(df).collect()] == [3, 0, None]
    assert [r["text_len"] for r in ops.count_tokens(df, len).collect()] == [6, 0, None]


def test_language_profiles(spark):
    labelled = spark.createDataFrame(
        [("the cat and the dog in the house", "en"), ("der hund und die katze in dem haus", "de")], "text string, lang string"
    )
    profiles = language.trigram_profiles(labelled, "text", "lang")
    df = spark.createDataFrame([(1, "the house and the dog"), (2, "die katze und der hund"), (3, "123")], "pos int, text string")
    assert [r["pos"] for r in language.lang_filter(df, profiles, "en", k=1).collect()] == [1]
    with pytest.raises(Exception, match="keep everything"):
        language.lang_filter(df, profiles, "en", k=2).collect()


def test_native_captions_need_no_python(spark):
    df = spark.createDataFrame([(1, "x", "static", 1.0)], "pos int, text string, cmotion string, aes double")
    out = df.select(captions.merge_camera_motion(captions.strip_caption_prefix(F.col("text")), F.col("cmotion")).alias("text"), "pos", "aes")
    assert "Python" not in plan_of(ops.add_scores_to_text(out))


@pytest.mark.parametrize("k", [1, 2])
def test_languages_are_scored_in_the_row(spark, rows, k):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang")
    odd = spark.createDataFrame([(-1, None, "en"), (-2, "", "en"), (-3, "12 34", "en"), (-4, "qqqqqq xxxx", "de"), (-5, "é", "fr")], docs.schema)
    profiles = language.trigram_profiles(docs, "text", "lang")
    both = docs.union(odd)
    for target in ("en", "fr", "nl"):
        got = language.lang_filter(both, profiles, target, k, key="doc_id")
        want = language.keep_top_languages(both, language.language_scores(both, profiles, "doc_id"), target, k, "doc_id")
        assert rows(got, "doc_id") == rows(want, "doc_id")
        assert "Exchange" not in plan_of(got)
    table = language.ProfileTable(profiles)
    own = both.select("doc_id", table.scores(F.col("text")).alias("s")).collect()
    want = {(r["doc_id"], r["lang"]): r["score"] for r in language.language_scores(both, profiles, "doc_id").collect()}
    assert {(r["doc_id"], lang): s for r in own for lang, s in zip(table.languages, r["s"]) if s} == want
