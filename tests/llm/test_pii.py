import hashlib
import re
import time

import pytest
from helpers import docs_df
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm import pii

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def brute(text):
    """The base patterns as they are written, one by one."""
    def good(kind, found):
        digits = re.sub("[^0-9]", "", found)
        if kind == "ip":
            return all(int(p) <= 255 for p in found.split("."))
        if kind == "card":
            total = sum(sum(divmod(2 * int(c), 10)) if k % 2 else int(c) for k, c in enumerate(digits[::-1]))
            return 16 <= len(digits) <= 19 and total % 10 == 0
        return kind != "phone" or 8 <= len(digits) <= 15
    return [(k, *m.span()) for k, (kind, p) in enumerate(PATTERNS.items()) for m in re.finditer(p, text) if good(kind, m.group())]


@settings(max_examples=1500, deadline=None)
@given(st.text(alphabet="a1.@-+ 0()5é", max_size=40))
def test_base_equals_the_patterns(text):
    assert pii.base_spans(text) == brute(text)


CASES = [
    ("write to john (at) example [dot] com now", "email", "john (at) example [dot] com"),
    ("ask John dot Smith at mail dot example dot org.", "email", "John dot Smith at mail dot example dot org"),
    ("jоhn@exаmple.cоm", "email", "jоhn@exаmple.cоm"),
    ("ｊｏｈｎ＠ｅｘａｍｐｌｅ．ｃｏｍ", "email", "ｊｏｈｎ＠ｅｘａｍｐｌｅ．ｃｏｍ"),
    ("a\u200bb@c\u200b.de", "email", "a\u200bb@c\u200b.de"),
    ("card: four" + " one" * 15, "card", "four" + " one" * 15),
    ("４１１１ １１１１ １１１１ １１１１", "card", "４１１１ １１１１ １１１１ １１１１"),
    ("no 4l11-1111-1111-1111", "card", "4l11-1111-1111-1111"),
    ("٤١١١١١١١١١١١١١١١", "card", "٤١١١١١١١١١١١١١١١"),
    ("call plus four four two zero seven nine four six zero one two", "phone", "plus four four two zero seven nine four six zero one two"),
    ("tel +49–30–1234567", "phone", "+49–30–1234567"),
    ("one nine two dot one six eight dot one dot one seven", "ip", "one nine two dot one six eight dot one dot one seven"),
    ("vier eins eins eins eins eins eins eins eins eins eins eins eins eins eins eins", "card",
     "vier eins eins eins eins eins eins eins eins eins eins eins eins eins eins eins"),
]


@pytest.mark.parametrize(("text", "kind", "found"), CASES)
def test_disguises_map_back(text, kind, found):
    spans = [(pii.KINDS[k], text[s:e], base) for k, s, e, base in pii.spans_of(text)]
    assert (kind, found, False) in spans
    assert pii.redacted(text, pii.spans_of(text)).count(f"[{kind.upper()}]") == 1


@pytest.mark.parametrize("text", [
    "look at the dot on the map", "we met at one two three Main Street", "one two three four five six seven eight nine", "x (at) y",
    "The dot at the end. At last, dot com was seven", "Größe über naïve façade señor", "l0l O1 oil 100 Illinois"])
def test_clean_texts_gain_nothing(text):
    assert pii.added_spans(text, pii.base_spans(text)) == []


@pytest.mark.parametrize(("found", "kind"), [
    ("john (at) example dot com", "email"), ("john at example [dot] com", "email"), ("john@example dot com", "email"),
    ("john (at) example dot museum", "email"), ("john at example dot dev", "email"), ("john dot smith at example.com", "email"),
    ("john dot smith (at) mail dot example.com", "email"), ("john@mail.example dot com", "email"),
    ("plus 4 four 2 zero 7 nine 4 six 0 one 2", "phone")])
def test_mixed_disguises(found, kind):
    text = f"call or write: {found}, now"
    assert (kind, found, False) in [(pii.KINDS[k], text[s:e], base) for k, s, e, base in pii.spans_of(text)]


@pytest.mark.parametrize("text", [
    "visit us at example.com today", "write to jo@ex.com dot the end", "the dot jo@ex.com is plain", "we met at noon dot nothing else",
    "one 2 three 4 dot", "at one dot two"])
def test_prose_gains_nothing(text):
    assert pii.added_spans(text, pii.base_spans(text)) == []


def test_base_spans_stay():
    text = "jo@ex.com and jо@ex.com, 4111 1111 1111 1111 and four" + " one" * 15
    spans = pii.spans_of(text)
    assert [s[:3] for s in spans if s[3]] == brute(text) and sum(not s[3] for s in spans) == 2


def test_table(spark):
    rows = [(1, "a@b.cd"), (2, None), (3, ""), (4, "x" * 200_000 + "@" + "y" * 100_000 + ".z 1.2.3.4"), (1, "a@b.cd"), (None, "+1 234 567 890"),
            (5, "john (at) example [dot] com"), (6, "1" * 60_000)]
    out = {(r.doc_id, r.spans): r for r in pii.digest(pii.find(docs_df(spark, rows))).collect()}
    for k, t in rows:
        base = brute(t or "") if k not in (4, 6) else pii.base_spans(t)
        text = ",".join(f"{pii.KINDS[a]}:{s}:{e}" for a, s, e in base)
        added = "email:0:27" if k == 5 else text
        r = out[k, added]
        assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(b[0] == a for b in base) for a in range(4))
    kept = {r.doc_id: r for r in pii.find(docs_df(spark, rows), keep=("doc_id", "block")).collect()}
    assert kept[2].redacted is None and kept[5].redacted == "[EMAIL]" and kept[1].block == "x"
    assert pii.find(docs_df(spark, [])).collect() == []


@pytest.mark.parametrize("piece", [" ", "\n", "a dot ", "(at) ", "a@", "a at ", "[dot]", " dot", "( ", "one  ", "a@b.cd ", "1 "])
def test_any_run_takes_linear_time(piece):
    """Four times the text takes about four times as long, also with a character that sets off every step."""
    def seconds(text):
        start = time.process_time()
        pii.spans_of(text)
        return time.process_time() - start

    for before, after in (("", ""), ("x (at) y.de", ""), ("“ x (at) y.de", " q at w dot de")):
        short, long = (seconds(before + piece * (n // len(piece)) + after) for n in (50_000, 200_000))
        assert long < 12 * max(short, 0.05), (piece, short, long)


def test_chains_and_neighbours():
    def added(text):
        return [text[s:e] for _, s, e, base in pii.spans_of(text) if not base]

    assert added("a dot b dot c (at) d dot e dot com") == ["a dot b dot c (at) d dot e dot com"]
    assert added("x at at y dot de") == ["at at y dot de"]  # the second word is a name
    assert added("j dot x.y (at) z dot org, k (at) l [dot] org") == ["x.y (at) z dot org", "k (at) l [dot] org"]
    assert added("a (at) b dot de (at) c dot de") == ["a (at) b dot de"]
