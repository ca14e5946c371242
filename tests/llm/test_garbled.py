from palimpsest.llm.garbled import garbled_words, infer, restored, undo

SCHEMA = "doc_id long, text string, record string, fixed string"


def test_undo_and_infer():
    assert undo("Ã©", "cp1252<-utf-8") == "é" and undo("ÃƒÂ©", "cp1252<-utf-8x2") == "é" and undo("é", "cp1252<-utf-8") is None
    assert "cp1252<-utf-8" in infer("crÃ©dit gÃ¼ltig", "crédit gültig") and infer("crédit", "credit é") == []
    assert "cp1252<-cp1251" in infer("Ìû 5", "Мы 5")


def frame(spark, extra):
    clean = [f"Für die Größe gelten übliche Gebühren, siehe Anhang {i}.\nL’équipe vérifie le crédit “{i}” – même si c’est âgé." for i in range(30)]
    return spark.createDataFrame([(i, t, "r", "f") for i, t in enumerate([*clean, *extra])], SCHEMA)


def test_found_and_restored(spark):
    wrong = "Für die Größe gelten übliche Gebühren, siehe Anhang 3."
    bad = [wrong.encode().decode("cp1252"), wrong.encode("mac_roman").decode("cp1252", "replace") if False else wrong.encode().decode("mac_roman"), wrong.encode().decode("ascii", "replace"), "L’équipe vérifie le crédit “4” – même si".encode().decode("cp1252", "replace")]
    good = [None, "", "plain & ascii &eacute;", "The letters Ã, Â, â and Ð.", "NÃO, ATENÇÃO", "Þór"]
    df = frame(spark, [*bad, *good])
    assert {r.doc_id for r in garbled_words(df).select("doc_id").distinct().collect()} == {30, 31, 32, 33}
    got = {r.doc_id: r for r in restored(df).collect()}
    assert got[30].text == wrong and got[30].fully and got[31].text == wrong and len(got) == 4


def test_clean_and_empty(spark):
    assert garbled_words(frame(spark, [])).count() == 0
    assert garbled_words(spark.createDataFrame([], SCHEMA)).count() == 0 and restored(spark.createDataFrame([], SCHEMA)).count() == 0


def test_garbled_copies_do_not_outvote(spark):
    clean = [f"Für die Größe gelten übliche Gebühren, siehe Anhang {i}.\nL’équipe vérifie le crédit “{i}” – même si c’est âgé." for i in range(30)]
    wrong = "Für die Größe gelten übliche Gebühren, siehe Anhang 3."
    for bad in (wrong.encode().decode("cp1252"), wrong.encode("cp1252").decode("mac_roman")):
        # a third of the rows are copies of one garbled text, one more is alike
        texts = [*clean, *[bad] * 20, bad.replace("3", "4"), *["plain"] * 10]
        df = spark.createDataFrame([(i, t, "r", "f") for i, t in enumerate(texts)], SCHEMA)
        got = {r.doc_id: r for r in restored(df).collect()}
        assert set(got) == set(range(30, 51)) and all(r.fully for r in got.values())
        assert {got[i].text for i in range(30, 50)} == {wrong}


def test_garbled_near_copies_do_not_outvote(spark):
    clean = [f"Für die Größe gelten übliche Gebühren, siehe Anhang {i}." for i in range(20)]
    texts = [*clean, *[f"Für die Größe gelten übliche Gebühren, siehe Anhang {i}.".encode().decode("cp1252") for i in range(20, 60)]]
    df = spark.createDataFrame([(i, t, "r", "f") for i, t in enumerate(texts)], SCHEMA)
    assert {r.doc_id for r in restored(df).where("fully").collect()} == set(range(20, 60))


def test_every_twin_counts(spark):
    # clauses without ASCII letters all share one skeleton; the twin is not the most frequent of them
    words = "закон право сторона договор оплата возврат адрес данные почта город страна услуга".split()
    clauses = [f"{a} {b} {c} {a} {b}" for a, b, c in zip(words, words[1:], words[2:])]
    bad = [c.encode("koi8_r").decode("cp1251") for c in clauses[:3]]
    texts = [*(f"{c}. {i}" for c in clauses for i in range(6)), *(f"{clauses[-1]}. {i}" for i in range(6, 15)), *bad]
    df = spark.createDataFrame([(i, t, "r", "f") for i, t in enumerate(texts)], SCHEMA)
    assert {r.doc_id: r.text for r in restored(df).collect()} == {len(texts) - 3 + i: clauses[i] for i in range(3)}


def test_losses_are_learned_from_twins(spark):
    """Replacement signs count where twins show what was lost; alone in a corpus they tell nothing."""
    clean = [f"Für die Größe gelten übliche Gebühren, siehe Anhang {i}." for i in range(10)]
    rows = lambda texts: spark.createDataFrame([(i, t, "r", "f") for i, t in enumerate(texts)], SCHEMA)
    got = {r.doc_id: r.fully for r in restored(rows([*clean, "die Gr\ufffd\ufffde gelten \ufffdbliche Geb\ufffdhren,", "\ufffdxyz"])).collect()}
    assert got == {10: True, 11: False}
    assert garbled_words(rows([*clean, "\ufffdxyz"])).count() == 0
