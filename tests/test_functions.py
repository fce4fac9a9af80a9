import random
import re

import pytest
from pyspark.sql import functions as F

from weftline.functions import scoring, text
from weftline.functions.vocabulary import CATEGORIES, GLYPHS, RECORD_COLUMNS, TEXT_FIELDS

# text as the register's font stores it -> what it prints; made up from the glyphs and the shapes that scoring repairs
PRINTED = {
    "௙ன்": "மீன்",
    "ேசாழ௖ரம்": "சோழபுரம்",
    "ெபான்௴ைள": "பொன்வீளை",
    "ைவைக": "வைகை",
    "க௔லன்": "கபிலன்",
    "ெகௗர௴": "கௌரவீ",
    "்ணன்": "தூணன்",
    "ாதர்": "சுதர்",
    "கனூ": "கனடி",
    "மாலை் த": "மால்தை",
    "சகர் ா": "சக்ரா",
    "நகரீ ் ": "நகீர்",
    "கந்ததாவா௘": "கந்தத சுவாமி",
    "ாந்தரதாவா௘": "சுந்தரதசுவாமி",
    "ஸ் வரன்": "ஸ்வரன்",
    "ெ ேெக": "ெ ேகெ",
    "ெ": "ெ",
    "": "",
    "abc": "abc",
}


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(f(F.col("x")).alias("y")).first().y


def test_sizes_of_fixed_values():
    assert len(RECORD_COLUMNS) == 100 and len(TEXT_FIELDS) == 29 and len(CATEGORIES) == 27 and len(GLYPHS) == 52


def test_repair_in_python_and_spark(spark):
    assert {k: scoring.repair(k) for k in PRINTED} == PRINTED
    rows = spark.createDataFrame([(k,) for k in PRINTED], "x string")
    assert {r.x: r.y for r in rows.select("x", scoring.repair_text("x").alias("y")).collect()} == PRINTED


def test_skeletons(spark):
    for x, want in [("அருள்மிகு வேலாயுத சுவாமி திருக்கோயில்", "வலயத"), ("கீழமணக்குடி", "ககமணககட"), ("", ""), (None, ""), ("abc", "")]:
        assert one(spark, x, text.skeleton) == want
    assert one(spark, "Shathamangalam", text.latin_skeleton) == "stmnglm"


@pytest.mark.parametrize(
    ("value", "function", "want"),
    [
        ("  தல விருட்சம் : ", text.normalize_label, "தலவிருட்சம்"),
        ("Agamam / Pooja :", text.normalize_label, "agamam/pooja"),
        (None, text.normalize_label, ""),
        (" a \t b \n", text.collapse, "a b"),
        (" a  b \r\n\n\n\n c ", text.clean_lines, "a b\n\nc"),
        ("–", text.clean_lines, ""),
        ("12.  Old  Name", text.strip_numbering, "Old Name"),
        ("x.php?cat=1&id=77", text.id_of_href, "77"),
        ("x.php?tid=77", text.id_of_href, None),
        ("a/new.php?cat=1&id=9#t", text.item_of_href, "9"),
        ("renew.php?id=9", text.item_of_href, None),
        ("download_picture.php?id=3&cat=594", text.item_of_href, "3"),
        ("k.php?a=1&cat=22#x", lambda x: text.query_param(x, "cat"), "22"),
        ("« 274 Sites Home ", text.category_text, "274 Sites"),
        ("ஊர் - 612 204.", text.pincode, "612204"),
        ("1612204 and 612204x", text.pincode, "612204"),
        ("6122045", text.pincode, ""),
        ("பழனி x", text.has_tamil, True),
        ("plain", text.has_tamil, False),
        ("a\x01b\n", text.cell_text, "ab\n"),
        ("abcd", text.ngrams, ["abc", "bcd"]),
        ("ab", text.ngrams, []),
        (None, lambda x: text.content_hash(F.coalesce(x, F.lit(""))), "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"),
        ("/x.php", lambda x: text.absolute_url("https://s.example", x), "https://s.example/x.php"),
        ("http://o.example/x", lambda x: text.absolute_url("https://s.example", x), "http://o.example/x"),
    ],
)
def test_text_functions(spark, value, function, want):
    assert one(spark, value, function) == want


def test_urls(spark):
    row = spark.createDataFrame([("7", 1)], "r string, p int")
    assert row.select(text.region_url("b", F.col("r"), F.col("p"))).first()[0] == "b/district_temple.php?id=7"
    assert row.select(text.region_url("b", F.col("r"), F.lit(3))).first()[0] == "b/district_temple.php?id=7&Page=3"
    assert row.select(text.detail_url("b", F.col("r"), english=True)).first()[0] == "b/en/new_en.php?id=7"


def test_names_of_three_letters_once(spark):
    row = spark.createDataFrame([("அருள்மிகு வேலாயுதர் கோயில்", "வேலாயுதர், முருகன்/கா (செல்லியம்மன்)")], "n string, m string")
    assert row.select(text.name_skeletons(F.col("n"), F.col("m"))).first()[0] == ["வலயதர", "மரகன", "சலலயமமன"]


def test_sentences(spark):
    split = lambda s: one(spark, s, text.sentences)
    assert split("This is one sentence. This is another one! And more?") == ["This is one sentence.", "This is another one!", "And more?"]
    assert split("Short. Then a longer sentence.") == ["Short. Then a longer sentence."]
    assert split("It is far away, 10 கி.மீ. from the town. It is old indeed.") == ["It is far away, 10 கி.மீ. from the town.", "It is old indeed."]
    assert split("   ") == [] and split(None) == []


def folded(line, least=15):
    """Sentences by the rule alone, piece by piece."""
    out = []
    for piece in re.split(r"(?<=[.?!।])\s+", line.strip()):
        if out and (len(out[-1]) < least or (out[-1].endswith(".") and "." in out[-1].split()[-1].rstrip("."))):
            out[-1] += " " + piece
        else:
            out.append(piece)
    return [s for s in out if s.strip()]


def test_sentences_equal_the_rule(spark):
    rng = random.Random(4)
    lines = [" ".join(rng.choice(["a", "bb ccc", "long enough words", "e.g.", "கி.மீ.", "x.", "So it ends.", "Why?", "no!"]) for _ in range(rng.randint(0, 40))) for _ in range(300)]
    got = spark.createDataFrame([(x,) for x in lines], "x string").select("x", text.sentences(F.col("x")).alias("s")).collect()
    assert all(r.s == folded(r.x) for r in got)


def test_glossary_whole_words_longest_first(spark):
    terms = {"கோயில்": "Temple", "பெரிய கோயில்": "Big $1 Temple"}
    assert one(spark, "பெரிய கோயில் கோயில் கோயிலில் கோயில்.", lambda x: text.apply_glossary(x, terms)) == "Big $1 Temple Temple கோயிலில் Temple."
    assert one(spark, "Sri Rama 12", lambda x: text.apply_rules(x, {r"(\w+) (\d+)": r"\2 \1$", "Sri": "Shri"})) == "Shri 12 Rama$"


def test_split_long():
    count = lambda t: len(t.split())
    assert scoring.split_long("a b c", count, 3) == ["a b c"]
    assert scoring.split_long("a b, c d, e f g h i", count, 4) == ["a b, c d", "e f g h", "i"]
    assert scoring.split_long("x" * 50, len, 10) == ["x" * 50]
    words = " ".join(["w"] * 300)
    pieces = scoring.split_long(words, count, 100)
    assert [count(p) for p in pieces] == [100, 100, 100] and " ".join(pieces) == words


def test_ratio_is_zero_for_blanks_and_keeps_order(spark):
    assert scoring.ratio("", "a") == 0.0 == scoring.ratio("a", None)
    rng = random.Random(1)
    rows = [("".join(rng.choice("abc") for _ in range(7)), "".join(rng.choice("abc") for _ in range(7))) for _ in range(50)]
    got = spark.createDataFrame(rows, "a string, b string").select("a", "b", scoring.text_ratio("a", "b").alias("r")).collect()
    assert all(r.r == scoring.ratio(r.a, r.b) for r in got) and any(scoring.ratio(a, b) != scoring.ratio(b, a) for a, b in rows)


@pytest.mark.parametrize(
    ("score", "runner", "pin", "has", "want"),
    [(0.87, 0.80, True, True, "exact"), (0.86, 0.801, True, True, "likely"), (0.9, 0.5, False, True, "likely"), (0.9, 0.5, False, False, "exact"), (0.75, 0.70, False, True, "likely"), (0.72, 0.691, True, True, "none"), (1.03, 1.03, True, True, "none"), (0.719, 0.0, True, True, "none"), (0.86, 0.0, True, True, "exact")],
)
def test_confidence_at_the_edges(spark, score, runner, pin, has, want):
    row = spark.createDataFrame([(score, runner, pin, has)], "s double, r double, p boolean, h boolean")
    assert row.select(text.confidence(F.col("s"), F.col("r"), F.col("p"), F.col("h"))).first()[0] == want


def test_link_score_rounds_half_to_even():
    assert scoring.link_score([], "x", 0.0, True) == 0.27 and scoring.link_score(["abc"], "abc", 1.0, True) == 1.03
    assert scoring.place_score("பனயர", "", [False], ["பனயர"]) == 1.0 and scoring.place_score("", "pnyr", [True], ["pnyr"]) == 1.0 and scoring.place_score("பனயர", "pnyr", [], []) == 0.0
