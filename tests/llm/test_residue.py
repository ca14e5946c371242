import pyarrow as pa

from palimpsest.llm.residue import FIELD, NUMBER, Matcher, fit, marked, places, residue_windows, word_codes, words
from palimpsest.llm.residue_exemplars import EXEMPLARS

SCHEMA = "chunk_id long, text string, line_no int, exemplar string"
FILLING = "The plan includes {} seats, of which {} expire each month. Guests can ask for a copy of the records by post."
BAD = [
    "Welcome to {{ company }}: sellers agree to label images.", "The contract is governed by the law of [INSERT DATE], see annex 3.", "500 Internal Server Error", "text before\nPlease enable JavaScript to view this page.\ntext after",
    "Lorem ipsum dolor sit amet, consectetur adipiscing elit", "TODO: write section 12", "Write to <%= contact_email %> within 6 hours.", "This policy of %%LEGAL ENTITY%% applies from __DATE__.", "asdf asdf qwer asdf", "xxxx xxxxx xxx xxxxxxx",
    "The site is down for maintenance; we will be back soon.", "Error 503: service unavailable. Request a1b2c3d4",
]
GOOD = [
    "The set 1, 2 and 3 of Tolor is written as {a, b, c} in annex 28.", "Terms in [square brackets] are explained in annex 14.", "The TODO list in Tolor holds up to 9 entries <b>per member</b>.", "If error 433 appears in Tolor, we store the nickname for 10 days.",
    "Our pages use JavaScript to plan capacity, and cookies are set on request.", "A page that is not found within 2 seconds counts as a failed visit to Tolor.", "Sample texts for Tolor are sent to parents after 90 days.", "Prices rise by 13% in Tolor, or by $ 579 for parents.",
    "Access is denied to guests before you move to another country, and the archive team keeps a log.", "", None, "x" * 100_000,
]
# wording that no exemplar has
UNSEEN = [
    "404 - the page was not found", "HTTP 500: internal server error", "The website is down for scheduled maintenance", "Please turn on JavaScript in order to view this site", "Sorry, an unexpected error occurred. Try again later.", "Access to this resource has been denied",
    "You are not authorised to access this server", "Too many requests - retry in 90 seconds", "Please verify that you are not a robot", "The session has timed out. Sign in to continue.", "Dummy text for layout only", "Placeholder paragraph, replace before publishing",
    "Enter your own text here", "Draft for internal review, not for distribution", "TBD by legal", "The controller is [Your registered company here].", "Write to [insert the address of the data protection officer].", "Dear ${first_name}, hello.", "We, <LEGAL ENTITY HERE>, run this shop.",
    "Die Seite wurde nicht gefunden", "Veuillez activer JavaScript dans votre navigateur", "La página no existe",
]
UNSEEN_POLICY = [
    "We keep error logs of our servers for 30 days.", "You may disable scripts in your browser at any time.", "We deny requests that the law does not allow.", "Maintenance windows are announced by mail two weeks before.", "The annex lists [optional] services.", "A draft of each change is published for comment.",
    "Your browser may block cookies set by partners.", "Sessions end when you sign out.", "Sample size and error rate are stated in the report.", "If the page cannot be loaded, the order is not placed.", "Values in (curly) style are examples.",
]


def frame(spark, texts):
    more = [FILLING.format(i, i % 7) for i in range(300)]
    return spark.createDataFrame([(i, t, 1, "e") for i, t in enumerate([*texts, *more])], SCHEMA)


def test_marks(spark):
    got = {r.chunk_id: r.is_residue for r in marked(frame(spark, BAD + GOOD)).collect()}
    assert all(got[i] for i in range(len(BAD))), [BAD[i] for i in range(len(BAD)) if not got[i]]
    wrong = [GOOD[i] for i in range(len(GOOD)) if got[len(BAD) + i]]
    assert not wrong and len(got) == len(BAD) + len(GOOD) + 300


def test_wording_not_in_the_list(spark):
    known = {t for _, t in EXEMPLARS}
    assert not known & {*UNSEEN, *UNSEEN_POLICY}
    got = {r.chunk_id: r.is_residue for r in marked(frame(spark, UNSEEN + UNSEEN_POLICY)).collect()}
    missed = [UNSEEN[i] for i in range(len(UNSEEN)) if not got[i]]
    wrong = [x for i, x in enumerate(UNSEEN_POLICY, len(UNSEEN)) if got[i]]
    assert len(missed) <= 0.1 * len(UNSEEN) and not wrong, (missed, wrong)


def test_line_numbers(spark):
    assert [(r.chunk_id, r.line_no) for r in residue_windows(frame(spark, BAD[3:4])).collect()] == [(0, 1)]


def test_tokens():
    assert words("Write to us by 2024, Ref a1b2") == ["write", "to", "us", "by", NUMBER, "ref", NUMBER]
    assert places("by {{ x.y }} or [Your company name] or [two words]") == [["open {{", FIELD, "close {{"], ["open [", "your", FIELD, "name", "close ["], ["open [", FIELD, "close ["]]
    assert places("see annex {a, b}") == [["open {", "a", "b", "close {"]]


def test_empty(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert residue_windows(df).count() == 0 and marked(df).count() == 0


def test_sentences_of_long_lines(spark):
    fill = " ".join(FILLING.format(i, i % 7) for i in range(2000))
    long = [f"{fill} {notice} {fill}" for notice in ("Please enable JavaScript to view this page.", "The site is down for maintenance; we will be back soon.")]
    got = {r.chunk_id: r.is_residue for r in marked(frame(spark, [*long, fill])).collect()}
    assert got[0] and got[1] and not got[2]


def test_places_are_scored_like_all_windows(spark):
    a, b = residue_windows(frame(spark, [BAD[0], "{{ company }}"])).orderBy("chunk_id").collect()
    assert a.exemplar == b.exemplar == "{{ name }}" and a.containment == b.containment == 1 and a.coverage == b.coverage == 1


def test_filler_is_learned(spark):
    """Invented words beside known filler become filler; words of ordinary texts don't."""
    taught = ["Lorem ipsum vobarit dolor semunque", "Dolor vobarit amet semunque kraletis", "Kraletis ipsum enim vobarit", "Lorem ipsum kraletis semunque", "Amet lorem vobarit kraletis semunque", "Ipsum dolor kraletis semunque vobarit"]
    df = frame(spark, [*taught, "Semunque vobarit kraletis vobarit.", "Guests can ask for a copy."])
    assert {"vobarit", "semunque", "kraletis"} <= fit(df, "text").filler and "guests" not in fit(df, "text").filler
    got = {r.chunk_id: r.is_residue for r in marked(df).collect()}
    assert got[6] and not got[7]


def test_posting_only_heavy_tokens_loses_nothing(spark):
    model = fit(frame(spark, BAD + GOOD + UNSEEN), "text")
    some, every = Matcher(model), Matcher(model)
    for k, bag in enumerate(every.bags):
        for t in bag:
            if k not in every.heads[t]:
                every.heads[t].append(k)
    every.looked_for = frozenset(every.heads) | every.filler
    texts = [x for x in BAD + UNSEEN + UNSEEN_POLICY + GOOD if x]
    assert [(i, n) for i, n, _ in some.batch(pa.array(texts))] == [(i, n) for i, x in enumerate(texts) for n, line in enumerate(x.split("\n")) if every.line(line)]


def test_words_of_many_strings():
    texts = ["Write to Us by 2024", "", "а\u200bcc\u200bess ｄｅｎｉｅｄ", "Straße 7b", "one two two"]
    at, code, names = word_codes(pa.array(texts))
    for i, x in enumerate(texts):
        assert sorted(names[c] for c in code[at == i] if names[c]) == sorted(words(x))
