import hashlib
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm.conftest import rows_of

from asterism.llm import personal_data as pd_
from asterism.llm.personal_data import KINDS, find_personal_data, mask, masked_documents, span_digests, spans_of

# the contract's patterns as they stand
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def plain_base(text):
    found = []
    for k, (kind, pattern) in enumerate(PLAIN.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": True,
                "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")),
                "card": 12 <= len(digits) <= 19 and luhn(digits),
                "phone": 9 <= len(digits) <= 15,
            }[kind]
            if good:
                found.append((m.start(), k, kind, m.end()))
    return [(kind, start, end) for start, _, kind, end in sorted(found)]


def base(text):
    return [s[:3] for s in spans_of(text) if s.base]


CASES = [
    "a@b.c@d.e@f.g",
    "mail x.y+z@ex-1.co.uk, not @b.c nor a@b",
    "..@a.b.. a@@b.c a@b..c %@-.-",
    "1.2.3.4.5.6.7.8 256.1.1.1 1.2.3.256 007.08.0.0255 1.2.3 .4.5.6.7",
    "4111 1111 1111 1111 4111-1111-1111-1111 4111  1111 41111111111111112",
    "+1 (743) 555-3824 +1((((( +12 +1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 +49.30-1234567) ++1 234 567 89",
    "naïve 日本語 4111111111111111 é@b.c",
    "٣.٣.٣.٣ ٤١١١١١١١١١١١١١١١",
]


@pytest.mark.parametrize("text", CASES)
def test_base_spans_are_those_of_the_plain_patterns(text):
    assert base(text) == plain_base(text)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="a@.-+ %_()0123456789()é\n", max_size=60))
def test_base_spans_of_any_text(text):
    assert base(text) == plain_base(text)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["1.2.3.4", "4111 1111 1111 1111", "a@b.cd", "+1 743 555 3824", ".", "@", " ", "9"])))
def test_base_spans_of_joined_pieces(parts):
    assert base("".join(parts)) == plain_base("".join(parts))


@pytest.mark.parametrize("text", ["a" * 300_000, "1" * 300_000, "1." * 150_000, "@a" * 100_000, "+1" + "(" * 300_000, "A1" * 100_000])
def test_long_runs_take_time_in_proportion(text):
    spans_of(text)


def kinds(text):
    return [s.kind for s in spans_of(text)]


def test_checksums_confirm():
    assert kinds("IBAN GB82 WEST 1234 5698 7654 32 for you") == ["iban"]
    assert kinds("GB82WEST12345698765432") == ["iban"]
    assert kinds("IBAN GB82 WEST 1234 5698 7654 33") == []  # one digit off
    assert kinds("DE89370400440532013000 GB82WEST12345698765432") == ["iban", "iban"]
    assert kinds("NO9386011117947 FOLLOWED BY WORDS") == ["iban"]
    assert kinds("NO9386011117947X") == []
    assert kinds("ZZ82WEST12345698765432") == []  # no such country


def test_words_nearby_decide():
    assert kinds("SSN 219-09-9999 here") == ["ssn"]
    assert kinds("part 219-09-9999 here") == []
    assert kinds("social security: 000-12-3456") == []
    assert kinds("call (743) 555-3824 now") == ["national_phone"]
    assert kinds("see (743) 555-3824 now") == []
    assert kinds("routing number 021000021") == ["routing"]
    assert kinds("routing number 021000022") == []
    assert kinds("a test: routing number 021000021") == []  # a word speaks against it
    scores = [spans_of(t)[0].score for t in ("test 4111111111111111", "4111111111111111", "visa 4111111111111111")]
    assert scores == sorted(scores) and len(set(scores)) == 3  # base spans stay at any score


def test_further_spans_lie_over_no_base_span():
    assert kinds("call +1 743 555 3824 now") == ["phone"]
    both = kinds("tel 743-555-3824, card 4111 1111 1111 1111")
    assert both == ["national_phone", "card"]
    many = spans_of("call 743-555-3824 or phone 743 555 3824 " * 50)
    assert len(many) == 100 and all(a.end <= b.start for a, b in zip(many, many[1:]))


def test_masks():
    assert mask("a@b.cd and 1.2.3.4!") == "[EMAIL] and [IP]!"
    assert mask("plain") == "plain" and mask(None) is None and mask("") == ""


def test_table_of_messy_documents(spark, messy):
    found = find_personal_data(messy)
    assert found.columns == ["doc_id", "spans"] and found.count() == messy.count()
    assert not any(r["spans"] for r in found.collect())
    assert masked_documents(messy).columns == messy.columns
    assert rows_of(masked_documents(messy)) == rows_of(messy)
    assert span_digests(find_personal_data(messy.limit(0))).count() == 0


def test_digests_equal_brute_force(spark, documents):
    texts = [*CASES, None, "", "call 743-555-3824 card 4111111111111111", "x " * 5000 + "a@b.cd"]
    docs = documents([(i, t) for i, t in enumerate(texts)] + [(0, texts[0]), (None, "a@b.cd")])
    got = span_digests(find_personal_data(docs)).collect()
    assert len(got) == len(texts) + 2
    for row in got:
        text = "a@b.cd" if row["doc_id"] is None else texts[row["doc_id"]] or ""
        want = plain_base(text)
        joined = ",".join(f"{k}:{s}:{e}" for k, s, e in want)
        assert row["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert [row[f"n_{k}"] for k in KINDS[:4]] == [sum(x[0] == k for x in want) for k in KINDS[:4]]
        spans = [tuple(s.split(":")) for s in row["spans"].split(",") if s]
        assert {(k, str(s), str(e)) for k, s, e in want} <= set(spans)
        assert spans == sorted(spans, key=lambda s: (int(s[1]), KINDS.index(s[0])))


def test_lists_of_words_and_lengths_are_whole():
    assert set(pd_.FOR) == set(KINDS) == set(pd_.BASE_SCORE)
    assert all(15 <= n <= 32 for n in pd_.IBAN_LENGTHS.values())
