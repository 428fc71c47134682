import hashlib
import random
import re

from tests.llm.helpers import frame, mixed_rows
from tripmart.llm import sanitise

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def digits(text):
    return [int(c) for c in text if c in "0123456789"]


def passes_luhn(values):
    doubled = [v if k % 2 == 0 else 2 * v - 9 * (v > 4) for k, v in enumerate(reversed(values))]
    return sum(doubled) % 10 == 0


def by_pattern(text):
    return {
        "email": [m.span() for m in EMAIL.finditer(text)],
        "ip": [m.span() for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))],
        "card": [m.span() for m in CARD.finditer(text) if 13 <= len(digits(m.group())) <= 19 and passes_luhn(digits(m.group()))],
        "phone": [m.span() for m in PHONE.finditer(text) if 9 <= len(digits(m.group())) <= 15],
    }


def test_base_spans_equal_the_plain_patterns():
    rng = random.Random(3)
    pieces = ["a", "b@", "@", ".", "..", "c.d", "-", "+", "1", "23", "255", "256", ".0", " ", "(", ")", "é", "%", "_",
              "4111111111111111", "+1 (386) 555-3733", "x@y.z", "00", "\n", "４"]
    for _ in range(4000):
        text = "".join(rng.choice(pieces) for _ in range(rng.choice([3, 8, 20, 60])))
        assert sanitise.base_spans(text) == by_pattern(text), text


def test_base_spans_stay_fast_on_long_runs():
    for text in ("1" * 200_000, "a" * 200_000 + "@", "@" * 200_000, "1." * 100_000, "+" + "(" * 200_000, "a@b." * 50_000):
        sanitise.base_spans(text)


def test_report_handles_every_kind_of_row(spark):
    rows = [*mixed_rows(), (90, "mail bob@x.org or +1 (386) 555-3733"), (91, "10.0.0.1 4111 1111 1111 1111"), (90, "mail bob@x.org")]
    out = sanitise.sanitise_report(frame(spark, rows)).collect()
    expected = []
    for doc_id, text in rows:
        spans = by_pattern(text or "")
        joined = ",".join(f"{k}:{s}:{e}" for k in sanitise.KINDS for s, e in spans[k])
        expected.append((doc_id, *(len(spans[k]) for k in sanitise.KINDS), hashlib.sha256(joined.encode()).hexdigest(), joined))
    got = [(r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256, r.spans) for r in out]
    assert sorted(got, key=str) == sorted(expected, key=str)
    assert sanitise.sanitise_report(frame(spark, [])).collect() == []


def test_words_that_name_an_entity_in_several_contexts_are_reported(spark):
    rng = random.Random(5)
    filler = [f"f{k}" for k in range(60)]
    rows = []
    for k in range(6):  # the nickname stands near this address wherever it is mentioned, in changing company
        a, b = rng.sample(filler, 8), rng.sample(filler, 8)
        rows.append((k, f"{' '.join(a)} Zorro bob@x.org {' '.join(b)}"))
    rows += [(10 + k, " ".join(rng.sample(filler, 30))) for k in range(80)]
    rows += [(200 + k, "copy of nobody sue@y.org here") for k in range(9)]  # copies are one context
    out = {r.doc_id: r for r in sanitise.sanitise_report(frame(spark, rows)).collect()}
    for k in range(6):
        text = dict(rows)[k]
        start = text.index("Zorro")
        assert f"remove:{start}:{start + 5}" in out[k].spans
        assert out[k].spans.startswith("email:")
        assert "Zorro" not in sanitise.redact(text, out[k].spans) and "bob" not in sanitise.redact(text, out[k].spans)
    assert all(out[10 + k].n_terms == 0 for k in range(80))
    assert all(out[200 + k].n_terms == 0 for k in range(9))


def test_a_revealing_term_far_from_the_mention_is_found_and_marked_everywhere(spark):
    rng = random.Random(6)
    filler = [f"f{k}" for k in range(60)]
    words = lambda n: " ".join(rng.choices(filler, k=n))
    rows = [(k, f"Zorro {words(30)} bob@x.org {words(30)} Zorro {words(20)} zorro") for k in range(6)]
    rows += [(10 + k, words(30)) for k in range(80)]
    out = {r.doc_id: r for r in sanitise.sanitise_report(frame(spark, rows)).collect()}
    for k in range(6):
        text = dict(rows)[k]
        assert all(f"remove:{m.start()}:{m.end()}" in out[k].spans for m in re.finditer("zorro", text.lower()))
        assert out[k].n_terms == 3 and "zorro" not in sanitise.redact(text, out[k].spans).lower()
    assert all(out[10 + k].n_terms == 0 for k in range(80))


def test_an_entity_of_two_documents_or_one_is_judged(spark):
    rng = random.Random(7)
    filler = [f"f{k}" for k in range(60)]
    words = lambda n: " ".join(rng.choices(filler, k=n))
    rows = [(k, f"Zorro {words(20)} bob@x.org {words(20)}") for k in range(2)]
    rows += [(5, f"{words(20)} sue@y.org Silver {words(20)} elsewhere")]  # what one text holds counts beside the mention only
    rows += [(10 + k, words(40)) for k in range(600)]
    out = {r.doc_id: r for r in sanitise.sanitise_report(frame(spark, rows)).collect()}
    assert all(":0:5" in out[k].spans and out[k].n_terms == 1 for k in range(2))
    start = rows[2][1].index("Silver")
    assert out[5].spans.endswith(f"generalise:{start}:{start + 6}") and out[5].n_terms == 1
    assert all(out[10 + k].n_terms == 0 for k in range(600))
