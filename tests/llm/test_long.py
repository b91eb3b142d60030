"""One very long text of an unhappy kind takes time linear in its length."""

import re
import time

import pytest

from lodestrand.llm import html_text, quality_rules, toxicity

MEGA = 1_000_000


def timed(f, *args):
    start = time.time()
    got = f(*args)
    assert time.time() - start < 8  # under a second by itself; other work may share the machine
    return got


@pytest.mark.parametrize("text", ["x" * MEGA, "x!" * (MEGA // 2), "-" * MEGA, "#" * MEGA, "| " * (MEGA // 2), ("y" * 999 + "## ") * 1000], ids=range(6))
def test_quality_rules(text):
    chars, symbols, *_ = timed(quality_rules.measure, text)
    assert chars == len(text) - text.count(" ") and symbols == sum(map(text.count, "#*$%&|<>"))


def test_words_that_end_in_signs():
    words = ["a##", "##", "#", "b!!", "!!c", "c!", "&&&", "d#%e", "~^", "é_=", "x" * 50 + "=="]
    plain = sum(bool(re.search(r"(!!|[#*$%&<>~^=_]{2})$", w)) for w in words)
    assert len(quality_rules._SIGNED.findall(" ".join(words))) == plain == 7


@pytest.mark.parametrize("text", ["-" * MEGA, "- " * (MEGA // 2), "x" * MEGA, "?!" * (MEGA // 2), "--\n" * (MEGA // 3), "bad " * (MEGA // 4)], ids=range(6))
def test_toxicity(text):
    model = toxicity.BagModel(-5.0, {"bad": 9.0})
    timed(model.scores, [text])
    assert len(timed(model.sentences, text)) == ("bad" in text)


def test_sentences():
    text = "One. -- ! Two three?\n\n...four -\n-"
    assert toxicity._sentences(text) == re.findall(r"[^.!?\n]*\w[^.!?\n]*", text) == ["One", " Two three", "four -"]


@pytest.mark.parametrize("sign", ["<script ", "<a ", "<a '", "<a '>'", '<a "x>', "<", "<!--", "<script>", "</script ", "<? ", "<div>", "&", "<a b=\"'>"])
def test_html(sign):
    page = "<p>Before the break.</p>" + sign * (MEGA // len(sign))
    assert timed(html_text.extract, page).startswith("Before the break.")
