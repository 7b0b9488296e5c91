"""Pages whose wrappers carry hints, and pages in languages without stop words in the list."""

import pytest

from wayfare.llm.maintext import main_text

TEXT = "It was the best of times and it was the worst of times, as the man had said to all of us there."
MORE = "And it is the end of the story that he had to tell us on the day that they were here with him."
MENU = "<ul>" + "".join(f"<li><a href='/{i}'>A link to the page {i}</a></li>" for i in range(8)) + "</ul>"


@pytest.mark.parametrize("wrapper", ["page has-sidebar", "content-with-sidebar", "post no-comments", "page--has-sidebar",
                                     "hasSidebar"])
@pytest.mark.parametrize("element", ["article", "main", "div"])
def test_hint_inside_a_class(wrapper, element):
    page = f"<body><nav>{MENU}</nav><div class='{wrapper}'><{element}><p>{TEXT}</p><p>{MORE}</p></{element}></div></body>"
    assert main_text(page) == f"{TEXT}\n{MORE}"


@pytest.mark.parametrize("element", ["article", "main"])
def test_wrapper_around_the_article(element):
    page = f"<div class='sidebar'><{element}><p>{TEXT}</p><p>{MORE}</p></{element}></div><div class='sidebar'>{TEXT}</div>"
    assert main_text(page) == f"{TEXT}\n{MORE}"


@pytest.mark.parametrize("hint", ["sidebar", "site-footer", "cookie-notice", "ad", "ad-slot-2", "relatedPosts", "footer--dark"])
def test_parts_stay_hidden(hint):
    part = f"<div class='{hint}'><p>{TEXT}</p></div>"
    assert main_text(f"<article><p>{MORE}</p><p>{TEXT}</p></article>{part}") == f"{MORE}\n{TEXT}"
    assert main_text(f"<div><p>{MORE}</p></div>{part}") == MORE
    teaser = f"<div class='{hint}'><article>Read on</article></div>"
    assert main_text(f"<div><p>{MORE}</p></div>{teaser}") == MORE


@pytest.mark.parametrize("text", [
    "Sokrates opetti Ateenassa nuorille miehille filosofiaa, eikä hän koskaan kirjoittanut ajatuksiaan muistiin itse.",
    "Wczoraj wieczorem pociąg przyjechał bardzo późno, dlatego wszyscy pasażerowie czekali cierpliwie na peronie.",
    "Вчера вечером поезд пришёл очень поздно, поэтому все пассажиры терпеливо ждали его на платформе вокзала."])
def test_other_languages(text):
    page = f"<div>{MENU}</div><div><p>{text}</p><p>{text[::-1]}</p></div><div>{MENU}</div>"
    assert main_text(page) == f"{text}\n{text[::-1]}"
