import random
import re

from pyspark.sql import functions as F

from threadtables.functions import content as C
from threadtables.functions import fields as FL
from threadtables.functions import text as T

SITE = "https://site.example"


def _apply(spark, values, f, schema="v string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, {schema}")
    return [r[0] for r in rows.orderBy("i").select(f(F.col("v"))).collect()]


BREAKS = "\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]"


def _own_words(text):
    """The rule in Python regexes: no quoted line, no run of blank lines, no blanks at the ends."""
    own = "\n".join(s for s in re.split(BREAKS, text) if re.match(r"\s*>", s) is None)
    return re.sub(r"\A\s+|\s+\Z", "", re.sub("\n\n\n+", "\n\n", own))


def test_quotes_are_stripped_like_the_rule(spark):
    fixed = ["> a\nb", "  > a\nb", "\u00a0> a\nb", "a\r\n> b\r\nc", "a > b", "\x1f> a\nb", "> only", "a\n\n\n\nb",
             "a\u2028> b", "", " a\u3000", "\x1e> x\x85y", "a\x0b> b\x0cc"]
    draw = random.Random(7)
    alphabet = ["a", ">", " ", "\n", "\n\n", "\r", "\r\n", "\t", "\u00a0", "\u2029", "\x1c", "\x1f", "\x85", "\x0b", "é"]
    texts = fixed + ["".join(draw.choices(alphabet, k=draw.randint(0, 14))) for _ in range(2000)]
    assert _apply(spark, texts, T.strip_quoted_text) == [_own_words(t) for t in texts]


def test_handles_and_signatures(spark):
    assert _apply(spark, ["V/Submission1/Reviewer_aB_c", "plain", ""], T.handle) == ["Reviewer aB c", "plain", ""]
    firsts = _apply(spark, [["a", "b"], [], None], T.first_signature, "v array<string>")
    assert firsts == ["a", "", ""]


def test_labels_start_anew_after_non_letters(spark):
    keys = ["summary", "other_strengths_and_weaknesses", "a1b_c-d", "ALL_caps", "rating"]
    assert _apply(spark, keys, T.pretty_label) == [FL.label(k) for k in keys]


def test_slugs(spark):
    assert _apply(spark, ["Accept (Oral)", "Reject", "(!)", "", "a--b"], T.bucket_slug) == [
        "Accept_Oral", "Reject", "Unknown", "Unknown", "a_b"]
    assert _apply(spark, ["Conf.cc/2030/Main"], T.venue_slug) == ["Conf_2030_Main"]


def test_excerpts(spark):
    cut = _apply(spark, [" abcdef ", "ab  cdef", "", None, "abc"], lambda c: T.excerpt(c, 4))
    assert cut == ["abcd ...", "ab ...", "_(empty)_", "_(empty)_", "abc"]
    assert _apply(spark, ["abcdef", "abc"], lambda c: T.shortened(c, 3)) == ["abc...", "abc"]


def test_authors(spark):
    rows = [(["A", "B", "C"], ["~a1", "b@x"]), (["A"], ["~a1", "~b1"]), ([], [])]
    df = spark.createDataFrame(rows, "names array<string>, ids array<string>")
    found = df.select(T.format_authors(F.col("names"), F.col("ids"), SITE).alias("a"), T.author_ids(F.col("ids")).alias("i"))
    assert [tuple(r) for r in found.collect()] == [
        (f"A ({SITE}/profile?id=~a1); B", ["~a1"]), (f"A ({SITE}/profile?id=~a1)", ["~a1", "~b1"]), ("", [])]
    assert _apply(spark, ["A (u) ;; B; "], T.split_author_cell) == [["A (u)", "B"]]


def test_stitched_text_keeps_list_order_and_skips_falsy(spark):
    df = spark.createDataFrame([('{"weaknesses": {"value": "w"}, "summary": "s", "questions": {"value": ""}, '
                                 '"review": {"value": 0}, "comments": "0", "rating": 8, "comment": "c", "response": "> q\\nr"}',)],
                               "content string").select(C.parse(F.col("content")).alias("p"))
    review, reply, meta = df.select(
        T.review_text(F.col("p")), T.reply_text(F.col("p")), T.meta_review_text(F.col("p"))).first()
    assert review == "Summary:\ns\n\nWeaknesses:\nw\n\nComments:\n0"
    assert reply == "c\n\nr"
    assert meta == "Summary:\ns"
