import random
import re
import zlib
from collections import Counter

import pytest
from llm.conftest import DOCUMENT, row

from tagtide.llm import spelling as S

LOWER = str.maketrans(S.UPPER, S.UPPER.lower())


def counted(rows):
    """Words and their counts, straight from the contract."""
    found = Counter()
    for doc_id, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            if h % 31 == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            found[word] += 1
    return {w: n for w, n in found.items() if len(w) >= 7 and n >= 2}


def one_apart(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(rows):
    n = counted(rows)
    near = {w: [v for v in n if one_apart(w, v)] for w in n}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 10 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return sorted(out)


def found(docs):
    return sorted(map(tuple, S.variants(docs).collect()))


def test_odd_rows(odd, odd_rows):
    assert found(odd) == brute(odd_rows)


def test_empty_table(none):
    assert found(none) == []


@pytest.fixture(scope="module")
def edited():
    """Words, their edits, edits of those and anagrams, with counts that make chains of forms."""
    rng = random.Random(13)
    letters = "aeinstéß"
    texts = []
    for _ in range(25):
        word = "".join(rng.choices(letters, k=rng.randint(7, 14)))
        for times in (400, 20, 2):
            texts += [word.upper() if rng.random() < 0.1 else word] * times
            at = rng.randrange(len(word))
            kind = rng.randrange(3)
            word = word[:at] + ("" if kind == 0 else rng.choice(letters)) + word[at + (kind < 2) :]
            if len(word) < 7:
                word += "sets"
        texts += ["".join(rng.sample(word, len(word)))] * 2
    texts += ["anagram", "nagaram", "managra"] * 3
    rng.shuffle(texts)
    return [row(i, " ".join(texts[i::90]) + " ××÷ tail-of text") for i in range(90)]


def test_chains_of_forms(spark, edited):
    rows = found(spark.createDataFrame(edited, DOCUMENT).repartition(3))
    assert rows == brute(edited)
    assert any(form and root != form for _, form, root, *_ in rows), "a form of a form"


def test_no_pair_is_lost(spark):
    """Signatures of every pair of words over few letters, where most are near something."""
    rng = random.Random(2)
    words = sorted({"".join(rng.choices("abcà", k=rng.choice([7, 7, 8, 8, 9]))) for _ in range(900)})
    frame = spark.createDataFrame([(w, i) for i, w in enumerate(words)], "word string, n long")
    pairs = sorted((r.word, r.near) for r in S.near_pairs(frame).collect())
    assert pairs == [(a, b) for a in words for b in words if one_apart(a, b)]


def test_letters_in_any_order_are_not_written(spark):
    """Anagrams share the letters' signatures; only pairs one edit apart leave the join."""
    rng = random.Random(3)
    words = sorted({"".join(rng.sample("abcdefghij", 10)) for _ in range(2000)})
    frame = spark.createDataFrame([(w, 5) for w in words], "word string, n long")
    assert S.near_pairs(frame).count() == 0


def test_runs(spark):
    rows = [
        row(1, "Straßenbahn STRAßENBAHN straßenbahn Äpfelwein äpfelwein Äpfelwein"),
        row(2, "sechsx sechsx toolong7toolong7 Ābcdefghi Ābcdefghi"),
        row(2, "x" * 5000 + " " + "x" * 5000),
    ]
    assert found(spark.createDataFrame(rows, DOCUMENT)) == brute(rows)
    assert {w for w, *_ in brute(rows)} >= {"straßenbahn", "toolong", "bcdefghi"}
