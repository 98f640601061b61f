"""Line-block distribution: the windows against a plain version, pages that wrap or interrupt their text, and time on long pages."""

import random
import time

import pytest
from seqloom.llm import html_text

LONG = " ".join(["many words of the story"] * 6)


def plain_blocks(size, window, surge):
    """Every window summed by itself; runs of lines whose windows aren't empty."""
    n, out, run = len(size), [], []
    for i in range(n + 1):
        if i < n and sum(size[i : i + window]) > 0:
            run.append(i)
            continue
        long = [j for j in run if size[j]]
        if long and any(sum(size[j : j + window]) > surge for j in run if j >= long[0]):
            out.append((long[0], long[-1] + 1))
        run = []
    return out


@pytest.mark.parametrize("window", [1, 2, 3, 5])
def test_runs_are_those_of_plain_windows(window):
    rng = random.Random(window)
    for _ in range(2000):
        size = [rng.choice([0, 0, 0, 1, 5, 40, 90]) for _ in range(rng.randint(0, 25))]
        assert html_text.blocks(size, window, 86) == plain_blocks(size, window, 86), size


def test_random_pages_give_the_lines_of_the_plain_windows():
    rng = random.Random(3)
    for _ in range(500):
        lines = [(rng.choice(["x", "short line", LONG]), rng.random() < 0.4) for _ in range(rng.randint(1, 20))]
        page = "".join(f"<div><a href=u>{t}</a></div>" if link else f"<p>{t}" for t, link in lines)
        size = [0 if link else len(t) for t, link in lines]
        found = plain_blocks(size, html_text.WINDOW, html_text.SURGE)
        want = [t for a, b in found for t, _ in lines[a:b]] if found else [t for (t, _), s in zip(lines, size, strict=True) if s]
        assert html_text.main_text(page) == "\n".join(want)


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (f'<div class="layout has-sidebar"><article><p>{LONG}</p><p>a b</p></article></div>', f"{LONG}\na b"),
        (f'<div id="page" class="site no-sidebar"><p>{LONG}</p></div>', LONG),
        (f'<div class="sidebar"><p>{LONG}</p></div>', LONG),
        (f"<form><p>{LONG}</p><p>x</p></form>", f"{LONG}\nx"),
        (f'<article><div class="page-header"><h1>T</h1></div><div class="social-science"><p>{LONG}</p></div></article>', f"T\n{LONG}"),
        (f"<article><p>{LONG}<iframe src=x><p>after it</article>", f"{LONG}\nafter it"),
        (f"<article><p>teaser</p></article><p>{LONG}</p><p>{LONG}</p><p>{LONG}</p>", "\n".join(["teaser", LONG, LONG, LONG])),
        (f'<article><p>short</p></article><div class="ad-slot">{LONG}</div><div id="comments-list"><p>{LONG}</p></div>', "short"),
        (f'<div class="comments"><p>{LONG}</p></div><p>tiny</p>', "tiny"),
        (f"<article><h1><a href=x>Head</a></h1><p>{LONG}</p><ul><li><a>1</a><li><a>2</a><li><a>3</a></ul><p>End.</p></article>", f"Head\n{LONG}\nEnd."),
        ("<head><title>x</title><body><p>hi</p>", "hi"),
        ("<p title='it's'>x</p> y 'z'", "x\ny 'z'"),
        ('<p title="a > b">x</p>', "x"),
        ("<p>1 < 2 and 3 > 2</p>", "1 < 2 and 3 > 2"),
        ('<p>a</p><img alt="never closed', 'a\n<img alt="never closed'),
    ],
)
def test_text_stays_and_the_rest_goes(page, text):
    assert html_text.main_text(page) == text


@pytest.mark.parametrize("unit", ["<a", "<i></i>", "<font>", '<a b=">', "<iframe>", "<div class=ad>x", "<p>abc def", "</title ", "<!--", "<ul><li>", "&amp"])
def test_time_is_linear(unit):
    """A page of a megabyte; a scan that starts anew at each tag would take minutes."""
    began = time.process_time()
    html_text.main_text("<title>" * (unit == "</title ") + unit * (1_000_000 // len(unit)))
    assert time.process_time() - began < 20
