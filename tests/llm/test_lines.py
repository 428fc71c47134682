import hashlib
import random

import numpy as np
from pyspark.sql import functions as F
from tests.llm.helpers import frame, mixed_rows, prose
from tripmart.llm import lines
from tripmart.llm.textarrays import Hasher


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def limit(chars):
    """None below 20 characters, 1 up to 39, 2 up to 319, one more with every fourfold length from there."""
    return 0 if chars < 20 else 1 if chars < 40 else 2 + sum(chars >= 320 * 4**k for k in range(9))


def by_pairs(rows):
    """Numbers of the lines to drop of every distinct (id, text)."""
    places = {}
    for doc_id, text in dict.fromkeys(rows):
        for k, line in enumerate((text or "").encode().split(b"\n")):
            line = line.strip(b" \t\r")
            if len(line) >= lines.LEAST_BYTES:
                places.setdefault(line, []).append((doc_id is None, doc_id, text, k))
    names = list(places)
    up = list(range(len(names)))

    def find(x):
        return x if up[x] == x else find(up[x])

    for i, a in enumerate(names):
        for j in range(i):
            b = names[j]
            x, y = a.decode(), b.decode()
            edits = limit(min(len(x), len(y)))
            if abs(len(x) - len(y)) <= edits and find(i) != find(j) and distance(x, y) <= edits:
                up[find(i)] = find(j)
    by_class = {}
    for i, a in enumerate(names):
        by_class.setdefault(find(i), []).extend(places[a])
    drop = {}
    for found in by_class.values():
        for _, doc_id, text, k in sorted(found, key=lambda p: (p[0], p[1] or 0, p[3]))[1:]:
            drop.setdefault((doc_id, text), set()).add(k)
    return drop


def case():
    rng = random.Random(9)
    lines_of = [prose(rng, 9) for _ in range(15)]
    near = [x[:20] + "#" + x[21:] for x in lines_of[:6]] + [x[:-1] for x in lines_of[6:9]] + ["zz" + x for x in lines_of[9:12]] + ["zzz" + x for x in lines_of[12:]]
    pool = lines_of + near + ["short", "All rights reserved.", "All rights reserved!", "", "   "]
    rows = [(200 + k, "\n".join(rng.choice(pool) + rng.choice(["", " ", "\r"]) for _ in range(rng.randrange(1, 7)))) for k in range(40)]
    return mixed_rows() + rows


def test_report_equals_brute_force(spark):
    rows = case()
    drop = by_pairs(rows)
    expected = []
    for doc_id, text in rows:
        gone = drop.get((doc_id, text), set())
        kept = "\n".join(x for k, x in enumerate((text or "").split("\n")) if k not in gone)
        expected.append((doc_id, 0 if text is None else text.count("\n") + 1, len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    got = [(r.doc_id, r.n_lines, r.n_dropped, r.kept_sha256) for r in lines.line_report(frame(spark, rows)).collect()]
    assert sorted(got, key=str) == sorted(expected, key=str)


def test_dropping_keeps_the_columns_and_counts_characters_anew(spark):
    rows = [(1, "a line of some length\nanother line of length"), (2, "a line of some length\nnew text"), (3, "a line of some length"), (4, None), (5, "")]
    docs = frame(spark, rows).withColumn("n_chars", F.length("text").cast("long"))
    out = lines.drop_repeated_lines(docs)
    assert out.columns == docs.columns
    got = {r.doc_id: (r.text, r.n_chars, r.key) for r in out.collect()}
    assert got == {1: (rows[0][1], 44, "x"), 2: ("new text", 8, "x"), 4: (None, None, "x"), 5: ("", 0, "x")}


def test_an_empty_table(spark):
    assert lines.line_report(frame(spark, [])).collect() == []


def test_banded_distance_equals_the_full_one():
    rng = random.Random(4)
    for _ in range(600):
        one = bytes(rng.choice(b"ab") for _ in range(rng.randrange(13)))
        others = [bytes(rng.choice(b"ab") for _ in range(rng.randrange(13))) for _ in range(6)]
        allowed = [rng.randrange(5) for _ in others]
        got = lines.within_edits(np.frombuffer(one, np.uint8), [np.frombuffer(o, np.uint8) for o in others], np.array(allowed))
        assert got.tolist() == [distance(one, o) <= k for o, k in zip(others, allowed, strict=True)]
    for edits in (7, 15, 16, 20):  # wider than 32 diagonals, too
        one = [rng.randrange(3) for _ in range(120)]
        others = []
        for k in range(30):
            other = list(one)
            for _ in range(k):
                at = rng.randrange(len(other))
                other[at:at + rng.randrange(2)] = [rng.randrange(3)] * rng.randrange(2)
            others.append(other)
        got = lines.within_edits(np.array(one, np.int32), [np.array(o, np.int32) for o in others], np.full(30, edits))
        assert got.tolist() == [distance(one, o) <= edits for o in others]


def edited(rng, line, edits, alphabet):
    """``line`` after so many random edits of single characters."""
    line = list(line)
    for _ in range(edits):
        at = rng.randrange(len(line))
        line[at:at + rng.randrange(2)] = rng.choice(alphabet) if rng.random() < 0.6 else ""
    return "".join(line)


def keys_of(texts):
    raw = [t.encode() for t in texts]
    data = np.frombuffer(b"".join(raw), np.uint8)
    chars = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
    bounds = np.cumsum([0, *map(len, texts)])
    held = {(kind, line): set() for kind in (1, 2) for line in range(len(texts))}
    for kind, keys, which in lines.segment_keys(Hasher(data), chars, bounds[:-1], np.diff(bounds)):
        for key, line in zip(keys.tolist(), which.tolist(), strict=True):
            held[kind, line].add(key)
    return held


def test_limits_and_classes(spark):
    assert lines.edit_limit(np.arange(6000)).tolist() == [limit(n) for n in range(6000)]
    table = spark.range(6000).select("id", lines._size_class(F.col("id")).alias("c"))
    classes = [r.c for r in table.orderBy("id").collect()]
    assert all(0 <= classes[n + limit(n)] - classes[n] <= 1 for n in range(5900)) and classes == sorted(classes)


def test_lines_within_the_limit_share_a_segment_at_every_length():
    rng = random.Random(5)
    pairs = 0
    for n in [1, 19, 20, 21, 39, 40, 41, 80, 100, 160, 300, 319, 320, 322, 640, 1279, 1281, 2560, 5000] * 12:
        alphabet = rng.choice(["ab", "abcé日𝄞"])
        a = "".join(rng.choice(alphabet) for _ in range(n))
        b = edited(rng, a, rng.randint(0, limit(n) + 1), alphabet)
        x, y = sorted((a, b), key=len)
        if x == y or not x or len(y) - len(x) > limit(len(x)):
            continue
        allowed = limit(len(x))
        code = lambda t: np.array([ord(c) for c in t], np.int32)
        if lines.within_edits(code(x), [code(y)], np.array([allowed]))[0]:
            assert n > 1000 or distance(x, y) <= allowed
            held = keys_of([x, y])
            assert held[1, 0] & held[2, 1], (n, len(x), len(y))
            pairs += 1
        elif n <= 1000:
            assert distance(x, y) > allowed
    assert pairs > 80


def test_long_and_foreign_lines_are_near(spark):
    rng = random.Random(8)
    base = ["".join(rng.choice("abcdefgh éß日") for _ in range(n)).strip() for n in (25, 45, 90, 350, 2000, 5000)]
    rows = [(k, t) for k, t in enumerate(base)]
    rows += [(10 + k, edited(rng, t, limit(len(t)) - 1, "xyzü")) for k, t in enumerate(base)]
    rows += [(20 + k, edited(rng, t, 4 * limit(len(t)) + 6, "0123456789")) for k, t in enumerate(base)]
    rows += [(30, base[1].replace(base[1][20], "語", 1))]  # one character, three bytes
    got = {r.doc_id: r.n_dropped for r in lines.line_report(frame(spark, rows)).collect()}
    drop = by_pairs([r for r in rows if len(r[1]) < 1000])
    assert {i: n for i, n in got.items() if n} == {i: 1 for i, t in rows if (i, t) in drop} | {14: 1, 15: 1}
    assert all(got[10 + k] == 1 for k in range(6)) and got[30] == 1


def test_lines_are_split_and_trimmed():
    texts = ["", "a", " a \n\tb\r\n", "\n\n", " \t", "é \nß"]
    raw = [t.encode() for t in texts]
    data, offsets = np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    got = [(int(r), int(n), data[s:e].tobytes()) for s, e, r, n in zip(*lines.split_lines(data, offsets), strict=True)]
    assert got == [(r, n, x.strip(b" \t\r")) for r, t in enumerate(raw) for n, x in enumerate(t.split(b"\n"))]


def test_short_lines_that_repeat_are_dropped(spark):
    rows = [(1, "Read more\nfirst text\n\nx"), (2, "second text\n Read more\r\n\n\nx"), (3, "Read more"), (4, "Read mor\n"), (5, "é\n\u00a0\né")]
    got = {r.doc_id: (r.n_lines, r.n_dropped, r.kept_sha256) for r in lines.line_report(frame(spark, rows)).collect()}
    kept = {1: rows[0][1], 2: "second text\n\n", 3: "", 4: rows[3][1], 5: "é\n\u00a0"}
    dropped = {1: 0, 2: 2, 3: 1, 4: 0, 5: 1}
    assert got == {i: (t.count("\n") + 1, dropped[i], hashlib.sha256(kept[i].encode()).hexdigest()) for i, t in rows}
