"""Fill-in-middle: units by chunks against the plain pattern, digests against a plain transformation, round trip."""

import hashlib
import itertools
import random

from hypothesis import given as given_by
from hypothesis import settings
from hypothesis import strategies as st

from coldhaul.llm import fim


def brute(doc_id, text):
    """(n, form, prefix characters, middle characters, output)."""
    text = text or ""
    units = fim.UNIT.findall(text)
    digest = hashlib.sha256(f"1:{'null' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * i:8 * i + 8], 16) for i in range(4))
    n = len(units)
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < 20:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@settings(max_examples=200, deadline=None)
@given_by(st.text(alphabet="abZ 1é\n\U0001f600<", max_size=400), st.integers(2, 5), st.integers(1, 9))
def test_units_by_chunks(text, bits, shortest):
    if not text:
        return
    ends = fim.chunk_ends(text, bits=bits, shortest=shortest, longest=40)
    assert ends == sorted(set(ends)) and ends[-1] == len(text)
    assert max(b - a for a, b in itertools.pairwise([0, *ends])) <= 40
    units = fim.Units(text, fim.ChunkCache(100), ends)
    starts = [u.start() for u in fim.UNIT.finditer(text)] + [len(text)]
    assert units.count == len(starts) - 1
    assert [units.offset(i) for i in range(len(starts))] == starts


def test_chunks_follow_content_and_are_remembered():
    rng = random.Random(3)
    shared = "".join(rng.choice("abcdefgh \n") for _ in range(20_000))
    cache = fim.ChunkCache()
    fim.Units("x" * 777 + shared, cache)
    seen = len(cache.held)
    assert seen > 30
    fim.Units("another head, " * 30 + shared, cache)
    assert cache.hits > 0.9 * seen
    small = fim.ChunkCache(1000)
    fim.Units(shared, small)
    assert small.chars <= 1000 and small.chars == sum(map(len, small.held))
    assert fim.Units(shared, small).count == len(fim.UNIT.findall(shared))


def test_equals_plain_transformation(spark, documents):
    rng = random.Random(5)
    alphabet = ["a", "B", " ", "é", "\n", "1", "word", "\U0001f600", "<", "P", "S", "M", ">", "<<S"]
    given = [(i, "".join(rng.choices(alphabet, k=rng.randint(1, 900)))) for i in range(120)]
    given += [(500 + i, f"a {s} b") for i, s in enumerate(("<P>", "<S>", "<M>"))]
    given += [(600, None), (601, ""), (602, "a" * 9000), (603, "word " * 400_000), (604, "<"), (None, "no id " * 50), (-7, "minus one"),
              (605, given[0][1]), (0, given[0][1]), given[1]]
    docs = documents(given)
    found = fim.transform(docs).collect()
    assert sorted(map(tuple, found), key=repr) == sorted([(i, *brute(i, t)) for i, t in given], key=repr)
    assert {r.form for r in found} == {"plain", "psm", "spm"}

    def digest(text):
        return hashlib.sha256((text or "").encode()).hexdigest()

    rows = fim.transform_digests(docs).select("doc_id", "output_sha256", "restored_sha256").collect()
    assert sorted(map(tuple, rows), key=repr) == sorted([(i, digest(brute(i, t)[4]), digest(t)) for i, t in given], key=repr)
    assert fim.transform_digests(documents([])).count() == 0
