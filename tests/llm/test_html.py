"""Pages on which place, stray tags or names mislead: the body stays, what is not text goes."""

from claimstar.llm import html

BODY = [
    "The river was in flood for a week, and it had taken the bridge that they built of wood in the year before.",
    "It was not the first time that the town had to do without it, and so they went on as they had done.",
]
PARAGRAPHS = "".join(f"<p>{p}</p>" for p in BODY)
TEXT = "\n\n".join(BODY)


def test_a_teaser_article_does_not_hide_the_body():
    page = f"<body><div>{PARAGRAPHS}</div><article><h3>Other story</h3></article></body>"
    assert TEXT in html.extract(page)


def test_an_anchor_without_an_address_is_no_link():
    assert html.extract(f"<body><a name=top>{PARAGRAPHS}</body>") == TEXT
    assert html.extract(f"<article><a name=top><a href=x>x</a>{PARAGRAPHS}</article>").endswith(TEXT)


def test_the_end_of_a_paragraph_ends_a_link():
    page = f"<article><p>A short note of the day, with <a href=x>a link</p>{PARAGRAPHS}</article>"
    assert html.extract(page).endswith(TEXT)


def test_names_that_hold_a_bad_word_are_not_bad():
    assert html.extract(f"<div class=social-science>{PARAGRAPHS}</div>") == TEXT
    for name in ("site-footer", "social-links", "nav menu", "left-sidebar"):
        assert html.extract(f"<article>{PARAGRAPHS}</article><div class='{name}'>{PARAGRAPHS}</div>") == TEXT
        assert html.extract(f"<div>{PARAGRAPHS}</div><div class='{name}'>{PARAGRAPHS}</div>") == TEXT


def test_raw_elements():
    assert html.extract(f"<article><svg width=1>{PARAGRAPHS}</article>") == TEXT
    assert html.extract(f"<article><svg><text>no</text></svg>{PARAGRAPHS}</article>") == TEXT
    assert html.extract(f"<article><script src=/a/>var x = 1;</script>{PARAGRAPHS}</article>") == TEXT
    assert html.extract(f"<article>{PARAGRAPHS}<script>var x = 1;") == TEXT
    assert html.extract(f"<article><svg/>{PARAGRAPHS}</article>") == TEXT


def test_a_linked_paragraph_of_the_article_stays():
    linked = f"<p><a href=x>{BODY[0]}</a> more</p>"
    assert html.extract(f"<article>{PARAGRAPHS}{linked}</article>") == f"{TEXT}\n\n{BODY[0]} more"


def test_density_and_neighbours_decide_without_an_article():
    links = "".join(f"<li><a href=/{n}>Section {n} of this site</a></li>" for n in range(9))
    long = " ".join(BODY)
    page = f"<body><ul>{links}</ul><p>{long}</p><p>Thus it was.</p><p>{long}</p><ul>{links}</ul></body>"
    assert html.extract(page) == f"{long}\n\nThus it was.\n\n{long}"


def test_odd_pages():
    for page in (None, "", " ", "<", "<a", "&amp", "<p", "<!--", "<article>", "<script>"):
        assert isinstance(html.extract(page), str)
    assert html.extract("<article><p>a &amp; b\n\t c</p></article>") == "a & b c"
