from __future__ import annotations

import random
import zlib
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from churnlens.llm import spelling
from tests.llm.helpers import documents


def one_apart(a: str, b: str) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(a) + 1 == len(b) and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute_force(docs, slips=False):
    total = Counter()
    for doc_id, text in docs:
        for run in spelling.RUNS.findall(text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if slips and h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            total[run] += 1
    n = {w: c for w, c in total.items() if len(w) >= 5 and c >= 3}
    near = {w: [v for v in n if one_apart(w, v)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best and n[best] >= 2 * n[w] else None

    def root(w):
        while form[w]:
            w = form[w]
        return w
    return sorted((w, form[w], root(w), n[w], len(near[w]), n.get(form[w])) for w in n)


def result(df):
    return sorted(tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect())


def texts(n, seed=3):
    """Words with slips: few letters, so that many words are near each other."""
    rng = random.Random(seed)
    base = ["".join(rng.choices("abé", k=rng.randint(4, 8))) for _ in range(60)]
    out = []
    for i in range(n):
        words = []
        for _ in range(rng.randint(0, 40)):
            w = base[min(int(rng.expovariate(0.07)), 59)]
            if rng.random() < 0.3:
                p = rng.randrange(len(w))
                w = rng.choice([w[:p] + w[p + 1:], w[:p] + rng.choice("abÉ") + w[p:], w[:p] + "B" + w[p + 1:]])
            words.append(w)
        out.append((i, rng.choice([" ", "-", ", ", "1"]).join(words)))
    return out


@pytest.mark.parametrize("frequent,longest", [(0, 4), (5, 5), (64, 3), (10**9, 4)])
def test_equals_brute_force(spark, frequent, longest):
    """Grams of all lengths, mixed ones, short ones only: the dictionary never loses a pair."""
    docs = texts(250)
    found = spelling.variants(documents(spark, docs).repartition(3), frequent=frequent, longest=longest)
    assert result(found) == brute_force(docs)


def test_slips_of_the_query(spark):
    docs = texts(300, 8)
    assert result(spelling.variants(documents(spark, docs), change=spelling.with_slips)) == brute_force(docs, True)


def test_awkward_rows(spark):
    docs = [(1, None), (2, ""), (None, "grape grape Grape"), (3, "grape" * 20_000), (4, "grope grope grope " * 40),
            (4, "grope grope grope " * 40), (5, "GRAPE×grape gräpe gräpe gräpe"), (6, "123 !? ..."), (7, "applé applé applé apple apple apple")]
    assert result(spelling.variants(documents(spark, docs))) == brute_force(docs)
    assert result(spelling.variants(documents(spark, []))) == []
    with pytest.raises(ValueError):
        spelling.variants(documents(spark, docs), min_length=3)


def test_chains_are_followed_to_the_last(spark):
    words = ["aaaaa", "aaaab", "aaabb", "aabbb", "abbbb", "bbbbb"]
    docs = [(i, " ".join([w] * 3 * 2 ** i)) for i, w in enumerate(words)]
    found = result(spelling.variants(documents(spark, docs)))
    assert {r[2] for r in found} == {"bbbbb"}
    assert found == brute_force(docs)


alphabet = st.sampled_from("abc")
word = st.text(alphabet, min_size=4, max_size=9)


@settings(max_examples=300, deadline=None)
@given(word, st.integers(0, 8), st.sampled_from(["insert", "delete", "replace"]), alphabet, st.sets(st.text("abc^$", min_size=2, max_size=4)))
def test_bounds_hold_for_any_dictionary(a, at, kind, c, dictionary):
    """Grams beyond the bound are in the edited word, at the same place or the next one."""
    at = min(at, len(a) - 1)
    b = {"insert": a[:at] + c + a[at:], "delete": a[:at] + a[at + 1:], "replace": a[:at] + c + a[at + 1:]}[kind]
    for x, y in ((a, b), (b, a)):
        mine = spelling.decompose(x, dict.fromkeys(dictionary, 1), 2, 4)
        its = spelling.decompose(y, dict.fromkeys(dictionary, 1), 2, 4)
        shifts = {0} if len(x) == len(y) else {0, len(y) - len(x)}
        shared = sum(any(0 <= p + s < len(its) and its[p + s] == g for s in shifts) for p, g in enumerate(mine))
        assert shared >= len(mine) - spelling.affected(mine)
        assert len(mine) == len(x) + 1
