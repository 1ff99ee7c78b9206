"""The labeller on pages labelled by hand."""

import re
from html import unescape

from hand_pages import PAGES

from scarmap.llm import html

MARKED = re.compile(r"\[\[(.*?)\]\]")


def measured():
    """Right blocks, blocks given, blocks wanted, and what went wrong."""
    right = given = wanted = 0
    wrong = []
    for number, page in enumerate(PAGES):
        want = [" ".join(unescape(x).split()) for x in MARKED.findall(page)]
        got = html.extract([MARKED.sub(r"\1", page)], html.trained())[0].split("\n")
        got = [g for g in got if g]
        both = [g for g in got if g in want]
        right, given, wanted = right + len(both), given + len(got), wanted + len(want)
        wrong += [(number, "lost", w) for w in want if w not in got] + [(number, "kept", g) for g in got if g not in want]
    return right, given, wanted, wrong


def test_precision_and_recall():
    right, given, wanted, wrong = measured()
    assert len(PAGES) == 40 and right >= 0.95 * wanted and right >= 0.95 * given, wrong
