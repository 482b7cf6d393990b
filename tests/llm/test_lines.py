"""Line dedup and collocations against brute force and SQL, and on odd rows."""

import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from compare import difference, duck
from farestrata.llm import bloom, collocations, lines, queries, sql
from test_corpus import FOLDER, ODD, docs

SPACES = " \t\n\x0b\x0c\r"
ASCII = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# --- filters -------------------------------------------------------------------------------------------------------


def test_filters_miss_nothing_and_unite():
    rng = np.random.default_rng(1)
    parts = [rng.integers(0, 1 << 63, 3_000).astype(np.uint64) for _ in range(3)]
    parts[2][:100] = parts[0][:100]
    size = bloom.size_for(9_000)
    filters = []
    for part in parts:
        once, twice = bloom.empty(size), bloom.empty(size)
        for some in np.array_split(part, 4):
            lines.enter(np.append(some, some[:1]), once, twice)
        filters.append([once, twice])
    whole = lines.unite(lines.unite(filters[2], filters[0]), filters[1])
    other = lines.unite(filters[0], lines.unite(filters[1], filters[2]))
    assert all((a == b).all() for a, b in zip(whole, other, strict=True))
    held = bloom.holds(whole[1], bloom.cells(np.concatenate(parts), size))
    assert held[:100].all() and held[6_000:6_100].all() and held.sum() < 600


def test_segments_give_the_filter_back(spark):
    size = bloom.LEAST_BITS * 2
    bits = bloom.empty(size)
    bloom.put(bits, bloom.cells(np.arange(5, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15), size))
    rows = [tuple(v[0] for v in row) for row in bloom.segments(bits)]
    frame = spark.createDataFrame(rows * 2, "segment int, bits binary")
    assert (bloom.united(frame, lambda a, b: [a[0] | b[0]], size)[0] == bits).all()


# --- lines ---------------------------------------------------------------------------------------------------------


def line_truth(rows):
    first = {}
    keys = lambda text: [line.strip(SPACES).translate(ASCII) for line in (text or "").split("\n")]
    rank = lambda i: (i is None, i or 0)
    for i, text in rows:
        for key in keys(text):
            first[key] = min(first.get(key, (True, 1)), rank(i))
    out = Counter()
    for i, text in rows:
        own = (text or "").split("\n")
        stay = [line for line, key in zip(own, keys(text), strict=True) if len(key) < 10 or first[key] >= rank(i)]
        out[i, len(own), len(own) - len(stay), "\n".join(stay)] += 1
    return out


SHARED = "A line that Many documents share"
LINES = [
    *ODD, (20, f"{SHARED}\nown line of twenty"), (21, f"  {SHARED.upper()}\t\n{SHARED}\n\nshort\n{SHARED}"), (22, f"short\n{SHARED}"),
    (None, f"{SHARED}\nonly with null ids"), (None, "only with null ids\nx"), (23, "ééééééééé\nééééééééé\nshort"), (24, "ééééééééé\n0123456789"),
    (24, "0123456789\nanother row of 24"), (24, "0123456789\nanother row of 24"), (25, "0123456789\nanother row of 24\n\n"), (19, "\n".join([SHARED] * 3)),
]


def test_lines_against_brute_force(spark):
    found = Counter(tuple(r) for r in lines.drop_repeated_lines(docs(spark, LINES)).collect())
    assert found == line_truth(LINES)


def test_a_crowded_filter_changes_nothing(spark, monkeypatch):
    """With nearly all cells set, every line is a suspect and the exact step decides alone."""
    rows = [(i, f"{SHARED}\nline number {i} of its own\nline number {i % 500} of two") for i in range(1_000)]
    monkeypatch.setattr(lines, "seen_twice", lambda docs, text_col, size: np.full(size // 8, 255, np.uint8))
    found = Counter(tuple(r) for r in lines.drop_repeated_lines(docs(spark, rows)).collect())
    assert found == line_truth(rows)


def test_no_lines(spark):
    assert lines.drop_repeated_lines(docs(spark, [])).collect() == []


def test_line_query(spark):
    assert difference(queries.op12_line_dedup(spark, FOLDER), duck(FOLDER), sql.oracle_sql()["op12_line_dedup"]) is None


# --- collocations --------------------------------------------------------------------------------------------------


def phrase_truth(rows, threshold, top=2_000):
    counts = defaultdict(Counter)
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(ASCII)):
            words = re.findall(r"[^\x20\x09]+", piece)
            for m in (1, 2, 3):
                counts[lang or "und"].update(tuple(words[i:i + m]) for i in range(len(words) - m + 1))
    out = set()
    for lang, f in counts.items():
        n = sum(v for p, v in f.items() if len(p) == 1)
        found = []
        for p, a in f.items():
            if len(p) == 1 or a < threshold:
                continue
            longer = (f[q] for q in f if len(q) == 3 and len(p) == 2 and p in (q[:2], q[1:]) and f[q] >= threshold)
            if any(100 * b >= 50 * a for b in longer):
                continue
            score, k = min((1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.add((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return out


def speech(spark, rows):
    return spark.createDataFrame([(lang, text, 1, 2, "x") for lang, text in rows], "lang string, text string, n int, words int, phrase string")


TALK = [("en" if i % 3 else "fr", f"The old Man said: the old man, {'new york city' if i % 2 else 'new york'} is é-{i % 4} far. Far a\tb  c d") for i in range(60)]
TALK += [(None, "a b a b a b a b a b a b"), ("und", "a b a b a b a b a b a b"), ("de", None), ("de", ""), ("de", " ... \n\n\t"), ("x", "a")]
TALK += [("a b", "c d"), ("a", "b c d")] * 12 + [("en", "x " * 5_000)] + [("es", "uno dos tres. " * 4)] * 9


@pytest.mark.parametrize(("threshold", "shards", "top"), [(10, 3, 2_000), (3, 2, 4), (1, 1, 50)])
def test_collocations_against_brute_force(spark, threshold, shards, top):
    found = {tuple(r) for r in collocations.collocations(speech(spark, TALK).repartition(5), threshold, top, shards).collect()}
    assert found == phrase_truth(TALK, threshold, top)


def test_phrases_that_become_frequent_late_are_counted_whole(spark, monkeypatch):
    """Strangers that are active by chance, from any scan on, are counted in vain, never wrongly."""
    activate = collocations.activate

    def crowded(cells, reached, length, scan):
        activate(cells, reached, length, scan)
        by_chance = np.random.default_rng(scan).random(len(cells)) < 0.6
        cells[by_chance & (cells == collocations.NEVER)] = scan

    monkeypatch.setattr(collocations, "activate", crowded)
    found = {tuple(r) for r in collocations.collocations(speech(spark, TALK[:70]), 5, 100, 2).collect()}
    assert found == phrase_truth(TALK[:70], 5, 100)


def test_chunks_end_where_texts_are_cut(monkeypatch):
    monkeypatch.setattr(collocations, "CHUNK", 7)
    texts = ["one two three, four", "five six", None, "", "seven"]
    parts = [bytes(c) for c in collocations.chunks(pa.array(texts))]
    assert b"".join(parts) == "\n".join(t or "" for t in texts).encode() and len(parts) > 2
    assert all(re.search(rb"[.,;:!?\n]\Z", p) for p in parts[:-1])


def test_no_phrases(spark):
    assert collocations.collocations(speech(spark, [])).collect() == []
    assert collocations.collocations(speech(spark, [("en", None), (None, "one")])).collect() == []


def test_scores_pass_64_bits(spark):
    big = 3_000_000_000_000
    phrases = spark.createDataFrame(
        [("en", 1, "a", big), ("en", 1, "b", big + 1), ("en", 2, "a b", big - 1)], "lang string, words int, phrase string, n bigint")
    row = collocations.scored(phrases).first()
    assert row.score == 1_000_000 * (big - 1) ** 2 // (big * (big + 1))


def test_collocation_query(spark):
    assert difference(queries.op13_collocations(spark, FOLDER), duck(FOLDER), sql.oracle_sql()["op13_collocations"]) is None


