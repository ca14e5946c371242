import pytest

from palimpsest.llm.lookalikes import affected, look_alike, looks_like, one_form

SCHEMA = "chunk_id long, text string, value string, canonical string"


@pytest.mark.parametrize("odd, plain", [
    ("ｐｌａｎ", "plan"), ("clаims", "claims"), ("be​hind", "behind"), ("Li\xadmits", "Limits"), ("a\xa0b", "a b"), ("ﬁle", "file"), ("café", "café"), ("𝗐𝗁𝗂𝗅𝖾", "while"), ("２０１０，", "2010,"), ("νorliegen", "vorliegen"),
])
def test_looks_like(odd, plain):
    assert looks_like(odd) == plain


@pytest.mark.parametrize("same", ["документ", "α", "Größere", "“quoted” – text…", "👩‍💻", "👨‍👩‍👧", "™", "m²", "½", "№", "a\tb", "利用規約は、更新。", "Ελληνική", "ª", "می‌خواهم", "10 €"])
def test_stays(same):
    assert looks_like(same) == same


def test_found_and_one_form(spark):
    texts = ["clаims and claims", "plain", None, "", "café café", "ﬁle\nｐｌａｎ x", "документ α", "clаims and claims", "x" * 50_000 + " be​hind"]
    df = spark.createDataFrame([(i, t, "c", "d") for i, t in enumerate(texts)], SCHEMA)
    assert {r.chunk_id for r in affected(df).collect()} == {0, 4, 5, 7, 8}
    got = {r.chunk_id: r.text for r in one_form(df).collect()}
    assert got[0] == got[7] == "claims and claims" and got[4] == "café café" and got[5] == "file\nplan x" and got[8].endswith(" behind")
    assert got[1] == "plain" and got[2] is None and got[3] == "" and got[6] == "документ α" and len(got) == len(texts)


def test_case_and_accents_are_kept(spark):
    df = spark.createDataFrame([(1, "Ｃafe cafe", "", ""), (2, "rеsume résumе", "", "")], SCHEMA)
    assert {r.chunk_id: r.text for r in one_form(df).collect()} == {1: "Cafe cafe", 2: "resume résume"}


def test_empty(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert affected(df).count() == 0 and one_form(df).count() == 0


def test_only_the_collation_brings_these_together(spark):
    """Spellings that the map leaves as they are come to one form because the collation holds them equal."""
    same = ["e\u0301le\u0300ve", "\u00e9le\u0300ve", "e\u0301l\u00e8ve", "\u00e9l\u200b\u00e8ve", "\u00e9\u2060l\u00e8\u200bve", "\u1ec7", "e\u0323\u0302", "e\u0302\u0323", "\u00ea\u0323"]
    assert all(look_alike(x) == x for x in same)
    df = spark.createDataFrame([(i, x) for i, x in enumerate(same)], "chunk_id long, text string")
    got = {r.chunk_id: r.text for r in one_form(df).collect()}
    assert {got[i] for i in range(5)} == {"\u00e9l\u00e8ve"} and {got[i] for i in range(5, 9)} == {"\u1ec7"}


def test_alphabets_and_emoji(spark):
    assert looks_like("д\u006fкумент") == "документ" and looks_like("\u0430ccess") == "access" and looks_like("\u0430\u200bccess") == "access" and looks_like("λ\u043eγος") == "λογος"
    keep = ["\U0001f469\u200d\U0001f4bb", "\U0001f469\U0001f4bb", "\u2764\ufe0f", "\u2764", "документ", "λόγος", "\U0001f3f4\U000e0067\U000e0062\U000e007f", "\U0001f3f4"]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(keep)] + [(90, "д\u006fкумент")], "chunk_id long, text string")
    assert {r.chunk_id for r in affected(df).collect()} == {90}
