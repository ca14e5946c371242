import itertools
import random

import numpy as np
import pytest

from palimpsest.llm.boilerplate import Chain, around_lines, leaf_blocks, main_body_of_html, main_lines, train
from palimpsest.llm.labelled_pages import labelled_pages

SCHEMA = "chunk_id long, text string, line_no int"


@pytest.fixture(scope="module")
def model():
    return train()


def test_viterbi_is_the_best_path():
    rnd = random.Random(2)
    for _ in range(100):
        move, begin, end = np.array([[rnd.gauss(0, 1) for _ in range(2)] for _ in range(2)]), np.array([rnd.gauss(0, 1), 0]), np.array([0, rnd.gauss(0, 1)])
        s = [rnd.gauss(0, 2) for _ in range(rnd.randint(1, 7))]
        total = lambda p: begin[p[0]] + end[p[-1]] + sum(x for x, y in zip(s, p) if y) + sum(move[a, b] for a, b in zip(p, p[1:]))
        assert total([int(x) for x in Chain({}, move, begin, end).decode(s)]) == pytest.approx(max(map(total, itertools.product((0, 1), repeat=len(s)))))


def test_pages_of_another_seed(model):
    wrong = rows = 0
    for p in labelled_pages(300, seed=99):
        got = model.decode([model.score(x, tags) for tags, x, _ in p])
        rows += len(p)
        wrong += sum(a != b for a, (_, _, b) in zip(got, p))
    assert wrong / rows < 0.03


# Everyday wording that no production of the grammar writes; each page is one chain.
AROUND = """Skip navigation
Sign in or create an account
Home / Customer care / Shipping information
Our website uses cookies to make sure you get the best experience. By using our website you agree to our use of cookies.
We and selected third parties use cookies as described in the cookie policy. Accept | Learn more and customise
Cookies help us deliver our services. By using our services, you agree to our use of cookies. Got it
This site uses cookies from partners to analyse traffic. See details  OK
Privacy preference center: manage consent preferences [Confirm my choices]
Published on 4 May 2021 by Jane Doe, 5 min read
Last updated 12/03/2024 | Reading time 3 minutes
Reviewed by the editorial board on 3 May 2022
1,204 views · 33 comments
You may also be interested in: travel insurance explained
Recommended reading: how to claim a refund
Trending stories this week: moving abroad
Share this story: Facebook | Twitter | Email
Print this article   Email this article
Did this answer your question? Yes No
Rate this page: 1 2 3 4 5
Leave us your feedback
Sign up for our weekly newsletter and never miss an offer
Follow us on Instagram | YouTube | TikTok
Download our app on the App Store or Google Play
Copyright 2023 Acme Corporation. All rights reserved.
Acme Ltd, 12 High Street, London. Registered in England no. 123456
Terms of sale | Privacy notice | Modern slavery statement | Cookie settings
Back to top of page
Select your country: United Kingdom | Ireland | France
Powered by WordPress
Prices include VAT. Delivery charges may apply.
Diese Seite nutzt Cookies, um Ihnen den besten Service zu bieten. Einverstanden
Teilen auf: Facebook | Twitter | per E-Mail
Ce site utilise des cookies pour vous offrir la meilleure expérience. J'accepte
Tous droits réservés © 2024 Acme
Utilizamos cookies propias y de terceros. Aceptar | Más información
Síguenos en Facebook | Instagram""".split("\n")
MAIN_TEXT = """1. Introduction
This privacy notice explains how we handle the information you give us.
We collect information when you register on our site, place an order or fill in a form.
What are cookies?
Cookies are small text files that are placed on your computer by websites that you visit.
You can set your browser to refuse cookies, but some parts of the site may then stop working.
We will never rent your e-mail address to anybody.
Your rights under data protection law
You have the right to ask us for copies of your personal information.
- the right to erasure;
- the right to object to processing.
If you share a link to our page on a social network, that network may learn of your visit.
Ratings and reviews you write are public and may be quoted by us.
We may print your name on the badge you receive at our events.
11.2 Limitation of liability
To the fullest extent permitted by law, we exclude all liability for indirect losses.
These terms are governed by the laws of England and Wales.
How long do we keep your data?
Invoices are retained for seven years in order to comply with tax law.
To subscribe to the newsletter you have to be at least sixteen years old; you may unsubscribe at any time.
The footer of each message tells you how to opt out.
We reserve the right to amend this policy, and will publish the new version on this page.
a) the name of the recipient,
b) the weight of the parcel.
Wir verarbeiten Ihre Angaben nur, soweit dies zur Erfüllung des Vertrags nötig ist.
Sie haben das Recht, Auskunft über Ihre gespeicherten Angaben zu verlangen.
Vous disposez d'un droit d'accès et de rectification de vos informations.
Nous ne vendons jamais vos informations à des tiers.
Usted tiene derecho a acceder a su información y a rectificarla.
No cedemos su información a terceros sin su consentimiento.""".split("\n")


def test_wording_the_grammar_does_not_write(model):
    """Lines alone, and in chains of furniture, main text and furniture."""
    written = {x.lower() for p in labelled_pages(2500) for _, x, _ in p}
    assert not written & {x.lower() for x in AROUND + MAIN_TEXT}
    gold = [(x, True) for x in AROUND] + [(x, False) for x in MAIN_TEXT]
    rnd = random.Random(4)
    pages = [[g] for g in gold] + [[(x, True) for x in rnd.sample(AROUND, 3)] + [(x, False) for x in rnd.sample(MAIN_TEXT, 6)] + [(x, True) for x in rnd.sample(AROUND, 3)] for _ in range(50)]
    for some in (pages[: len(gold)], pages[len(gold) :]):
        got = [(x, y, z) for p in some for (x, y), z in zip(p, model.decode([model.score(x) for x, _ in p]))]
        both = sum(y and z for _, y, z in got)
        assert both / sum(y for _, y, _ in got) >= 0.9 and both / sum(z for _, _, z in got) >= 0.9, sorted({(x, z) for x, y, z in got if y != z})


def test_lines(spark, model):
    page = "Home > Legal > Privacy policy\nCookies for profiling\nYour search history may be kept for 30 days.\n\nFollow the cookie rules of Tolor when you share posts, and subscribe only once.\nWas this page helpful? Yes / No\n© 2020 Tolor Bend. All rights reserved."
    df = spark.createDataFrame([(1, page, 0), (2, None, 0), (3, "", 0), (1, page, 0), (4, " \n\t", 0), (5, "500 Internal Server Error", 0), (6, "x " * 50_000, 0)], SCHEMA)
    assert sorted(map(tuple, around_lines(df).where("chunk_id < 6").collect())) == sorted([(1, n) for n in (0, 5, 6)] * 2)
    got = main_lines(df).where("chunk_id = 1").first().text
    assert got.split("\n")[0] == "Cookies for profiling" and got.endswith("only once.")
    assert around_lines(df.limit(0)).count() == 0


def test_html(spark, model):
    html = "<html><head><title>t</title></head><body><nav><a>Home</a> <a>Careers</a></nav><main><h1>Use of Tolor</h1><p>We <b>may</b> use the records for 30 days.</p><script>x()</script></main><footer>© 2020 Tolor Bend. All rights reserved.</footer></body></html>"
    assert leaf_blocks(html)[:3] == [("html body nav a", "Home"), ("html body nav a", "Careers"), ("html body main h1", "Use of Tolor")] and leaf_blocks("") == []
    assert leaf_blocks('<div class="main-menu" id=top><p><a>We</a> use <b>data</b>.</p></div>') == [("div .main .menu .top p", "We use data.")]
    df = spark.createDataFrame([(1, html), (2, None), (3, "")], "page_id long, html string")
    assert {r.page_id: r.text for r in main_body_of_html(df, "page_id", "html").collect()} == {1: "Use of Tolor\nWe may use the records for 30 days.", 2: None, 3: ""}
