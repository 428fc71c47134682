import itertools
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tests.llm.helpers import EXTRA, frame, mixed_rows
from tokenizers import Tokenizer
from tripmart.llm import packing
from tripmart.llm.textarrays import flat


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


def own():
    """A function from texts to their ids by the operator's own way."""
    tokens = packing.WordTokens(packing._content(None))

    def encode(texts):
        ids, bounds = tokens.encode(*flat(pa.array(texts, pa.string())))
        return [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])]

    return encode


def best_fill(lengths, room):
    """The fullest sum of at most ``room``, by all subsets."""
    return max(s for k in range(len(lengths) + 1) for c in itertools.combinations(lengths, k) if (s := sum(c)) <= room)


@pytest.mark.parametrize("seed", range(30))
def test_fullest_combination(seed):
    rng = random.Random(seed)
    lengths = [rng.randint(1, 30) for _ in range(rng.randint(0, 11))]
    room = rng.randint(0, 80)
    chosen = packing.fullest(Counter(lengths), room)
    assert sum(a * n for a, n in chosen) == best_fill(lengths, room)
    assert all(n <= Counter(lengths)[a] for a, n in chosen)


@pytest.mark.parametrize("seed", range(20))
def test_every_sequence_has_the_least_slack_of_what_is_left(seed):
    rng = random.Random(seed)
    lengths = [rng.randint(1, 20) for _ in range(rng.randint(1, 14))]
    left = Counter(lengths)
    for times, combination in packing.minimum_bin_slack(dict(left), 20):
        for _ in range(times):
            longest = max(a for a, n in left.items() if n)
            assert combination[0][0] == longest
            others = list(left.elements())
            others.remove(longest)
            assert sum(a * n for a, n in combination) == longest + best_fill(others, 20 - longest)
            left.subtract(dict(combination))
    assert not any(left.values())


def test_few_sequences():
    rng = random.Random(1)
    counts = Counter(min(4096, int(rng.lognormvariate(5.5, 1.2)) + 1) for _ in range(30000))
    total = sum(a * n for a, n in counts.items())
    assert sum(times for times, _ in packing.minimum_bin_slack(counts)) <= -(-total // 4096) + 2


def test_many_equal_lengths_are_one_pattern():
    assert packing.minimum_bin_slack({4096: 10**9, 1024: 4 * 10**9}) == [(10**9, [(4096, 1)]), (10**9, [(1024, 4)])]
    assert packing.minimum_bin_slack({}) == []


def test_ids_equal_the_library(library):
    tokens = own()
    rng = random.Random(2)
    points = [chr(c) for c in itertools.chain(range(0xD800), range(0xE000, 0x11000), range(0x1F300, 0x1F700), range(0x20000, 0x20100))]
    texts = []
    for k in range(0, len(points), 24):  # every code point inside a word, alone and beside a sign
        texts.append(" ".join(f"a{c}b {c} {c}. E{c}'s" for c in points[k:k + 24]))
    alphabet = ["a", "É", "é", "İ", "Σ", "ß", " ", "\n", " ", "\u0085", "\x1c", "'s", "'LL", ".", "<|endoftext|>", "<|ENDOFTEXT|>", "<|", "7", "日本", "¼", "%%%", "‍"]
    texts += ["".join(rng.choices(alphabet, k=rng.randint(0, 30))) for _ in range(3000)]
    for text, ids in zip(texts, tokens(texts), strict=True):
        assert ids == library(text), repr(text)


def test_a_full_dictionary_changes_nothing(library, monkeypatch):
    monkeypatch.setattr(packing, "DICTIONARY_WORDS", 50)
    tokens = own()
    rng = random.Random(3)
    for _ in range(60):
        texts = [" ".join(f"word{rng.randrange(60)}{rng.choice(['', ',', '!'])}" for _ in range(20)) for _ in range(3)]
        assert tokens(texts) == [library(t) for t in texts]
    assert tokens([]) == [] and tokens(["", " \n"]) == [[], []]


def check(rows, out, library, capacity):
    """Every piece of every document is there, in its place, and no place is taken twice."""
    expected = Counter()
    for doc_id, text in rows:
        ids = [*library(text), 1]
        for k, start in enumerate(range(0, len(ids), capacity)):
            part = ids[start:start + capacity]
            expected[doc_id, k, start, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
    assert Counter(tuple(r[:5]) for r in out) == expected
    places = defaultdict(list)
    for r in out:
        places[r.sequence_id].append((r.offset, r.length))
    for used in places.values():
        at = 0
        for offset, length in sorted(used):
            assert offset == at
            at += length
        assert at <= capacity
    return len(places)


@pytest.mark.parametrize("capacity", [4096, 64])
def test_packed_pieces(spark, library, capacity):
    rows = mixed_rows() + [(500 + k, "same length here") for k in range(200)]
    out = packing.packed_pieces(frame(spark, rows).repartition(7), capacity=capacity)
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    got = out.collect()
    n = check(rows, got, library, capacity)
    assert n <= -(-sum(r.length for r in got) // capacity) + 1


def test_sequences_hold_the_documents(spark, library):
    rows = mixed_rows()
    packed = sorted(tuple(r.ids) for r in packing.sequences(frame(spark, rows), capacity=512).collect())
    assert sum(map(len, packed)) == sum(len(library(t)) + 1 for _, t in rows)
    assert Counter(itertools.chain.from_iterable(packed)) == Counter(i for _, t in rows for i in [*library(t), 1])
    assert all(len(p) <= 512 for p in packed)


def test_clashing_columns_and_empty_table(spark, library):
    docs = spark.createDataFrame([(1, "a b", 5, 5, 5)], "doc_id long, text string, rank long, length long, task long")
    check([(1, "a b")], packing.packed_pieces(docs).collect(), library, 4096)
    assert "rank" not in EXTRA
    assert packing.packed_pieces(frame(spark, [])).collect() == []
