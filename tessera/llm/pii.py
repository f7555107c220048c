"""Personal data: base patterns, and an offset-preserving deobfuscation.

Base spans come from four patterns (email, ip, card, phone) on the text as it
is. The deobfuscation rewrites a text by transducers that keep, for every
character they write, the source range it stands for:

* characters: full-width forms, other scripts' digits, look-alike letters,
  dashes and spaces become ASCII, invisible characters vanish;
* digits: runs of at least MIN_SPELLED spelled digits (English, German, Spanish,
  French; "plus" and "dot" inside a run too), and look-alike letters inside long
  digit runs, become digits;
* addresses: each separator is plain, bracketed ("(at)", "[dot]") or spelled on
  its own. After a plain or bracketed "at" any last label counts; after a spelled
  one a last spelled or plain dot asks for a known label, and "name at host.tld"
  without any disguised dot is prose.

The base patterns then run on the rewritten text and their spans are mapped
back. A mapped span is added unless a base span of its kind covers it, so clean
texts gain nothing and base spans always stay. A text without any trigger of
the transducers is not rewritten at all.

Defined results: a null text is empty and has no spans; offsets are code points,
end exclusive; repeated rows are judged one by one; other columns are carried by
``keep``.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_right

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
MIN_SPELLED = 7

_local = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_domain = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_ip = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_card = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_phone = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_digit = re.compile(r"[0-9]")


def emails(text: str) -> list[tuple[int, int]]:
    """Found from each "@" outwards, so a long word without one costs nothing."""
    out, past = [], 0
    at = text.find("@")
    while at >= 0:
        begin = at
        while begin > past and text[begin - 1] in _local:
            begin -= 1
        end = 0
        if begin < at and (m := _domain.match(text, at)):
            end = m.end()
            out.append((begin, end))
            past = end
        at = text.find("@", max(at + 1, end))
    return out


def _is_ip(found: str) -> bool:
    return all(len(p := part.lstrip("0")) <= 3 and int(p or "0") <= 255 for part in found.split("."))


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c)
        if k % 2:
            d = d * 2 - 9 * (d > 4)
        total += d
    return total % 10 == 0


def _is_card(found: str) -> bool:
    digits = found.replace(" ", "").replace("-", "")
    return 16 <= len(digits) <= 19 and luhn(digits)


def _is_phone(found: str) -> bool:
    return 8 <= len(_digit.findall(found)) <= 15


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) by kind, then start."""
    out = [(0, s, e) for s, e in emails(text)]
    for kind, pattern, good in ((1, _ip, _is_ip), (2, _card, _is_card), (3, _phone, _is_phone)):
        out += [(kind, *m.span()) for m in pattern.finditer(text) if good(m.group())]
    return out


# Letters of other scripts that look like a Latin one.
LOOK_ALIKES = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s", "ԁ": "d",
    "һ": "h", "ӏ": "l", "ԛ": "q", "ԝ": "w", "в": "b", "к": "k", "м": "m", "н": "h", "т": "t", "А": "A", "В": "B",
    "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "Х": "X", "І": "I", "Ј": "J",
    "Ѕ": "S", "α": "a", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x",
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P",
    "Τ": "T", "Υ": "Y", "Χ": "X", "ı": "i", "ɑ": "a", "ɡ": "g", "ⅼ": "l", "․": ".", "。": ".", "﹫": "@", "∙": ".",
}
# The ten digits as words.
DIGIT_WORDS = {
    "en": "zero one two three four five six seven eight nine",
    "de": "null eins zwei drei vier fünf sechs sieben acht neun",
    "es": "cero uno dos tres cuatro cinco seis siete ocho nueve",
    "fr": "zéro un deux trois quatre cinq six sept huit neuf",
}
_spelled = {w: str(d) for words in DIGIT_WORDS.values() for d, w in enumerate(words.split())}
_word = "|".join(sorted(_spelled, key=len, reverse=True))
_item = rf"(?:{_word}|dot|plus|[0-9]+)(?![^\W_])"
_run = re.compile(rf"(?<![^\W_]){_item}(?:[\s,-]+{_item}){{{MIN_SPELLED - 1},}}", re.IGNORECASE)
# Any run that counts has a digit word with an item after it.
_some_spelled = re.compile(rf"[\W_](?:{_word})[\s,-]+(?:{_word}|dot|plus|[0-9])")
_run_item = re.compile(_item, re.IGNORECASE)
_strange = re.compile(r"[^\x00-\x9f\xa1-\xac\xae-\xff]|[\xa0\xad]")
# A run of white space is tried once, from its start; possessive repeats never give back.
_lead = r"(?:(?<!\s)\s++)?"


def _bracketed(words: str) -> str:
    return "(?:" + "|".join(rf"{o}\s*+(?:{words})\s*+{c}" for o, c in (("\\[", "\\]"), ("\\(", "\\)"), ("\\{", "\\}"), ("<", ">"))) + ")"


_bracket_at = re.compile(rf"{_lead}{_bracketed('at|@')}\s*+", re.IGNORECASE)
_bracket_dot = re.compile(rf"{_lead}{_bracketed('dot|[.]')}\s*+", re.IGNORECASE)
_hidden_dot = re.compile(rf"{_bracket_dot.pattern}|(?<!\s)\s++dot\s++", re.IGNORECASE)
# A hidden dot without the white space after it, which may be that before the next one.
_dot_head = re.compile(rf"{_lead}{_bracketed('dot|[.]')}|(?<!\s)\s++dot(?=\s)", re.IGNORECASE)
_space = re.compile(r"\s*+")
_at = re.compile(rf"@|{_bracket_at.pattern}|(?<!\s)\s++at\s++", re.IGNORECASE)
_domain_chain = re.compile(rf"[A-Za-z0-9-]++(?:(?:\.|{_hidden_dot.pattern})[A-Za-z0-9-]++)+", re.IGNORECASE)
_domain_dot = re.compile(rf"\.|{_hidden_dot.pattern}", re.IGNORECASE)
_dot_word = re.compile(r"\sdot\s", re.IGNORECASE)
# Last labels accepted after a spelled " dot " that also occurs in prose; country codes, then others.
TOP_LEVELS = frozenset((
    "ac ad ae af ag ai al am ao aq ar at au aw ax az ba bb bd be bf bg bh bi bj bm bn bo br bs bt bw by bz ca cc cd cf cg ch ci "
    "ck cl cm cn co cr cu cv cw cx cy cz de dj dk dm dz ec ee eg er es et eu fi fj fk fm fo fr ga gd ge gf gg gh gi gl gm "
    "gn gp gq gr gs gt gu gw gy hk hm hn hr ht hu id ie il im in io iq ir it je jm jo jp ke kg kh ki km kn kp kr kw ky kz la lb lc "
    "li lk lr ls lt lu lv ly ma mc md me mg mh mk ml mm mn mo mp mq mr ms mt mu mv mw mx my mz na nc ne nf ng ni nl no np nr nu nz "
    "om pa pe pf pg ph pk pl pm pn pr ps pt pw py qa re ro rs ru rw sa sb sc sd se sg sh si sk sl sm sn sr ss st su sv sx sy sz "
    "tc td tf tg th tj tk tl tm tn tr tt tv tw tz ua ug uk us uy uz va vc ve vg vi vn vu wf ws ye yt za zm zw "
    "com org net edu gov mil int info biz dev app xyz online site tech store cloud shop club blog mobi pro name email").split())
_mixed = re.compile(r"(?<![A-Za-z0-9])\+?[0-9OoIl](?:[ ().-]{0,2}[0-9OoIl]){9,}(?![A-Za-z0-9])")
_mixed_trigger = re.compile(r"[0-9][ ().-]{0,2}[OoIl]")
_brackets = re.compile(r"[\[({<]\s*(?:at|dot|@|\.)\s*[\])}>]", re.IGNORECASE)


def _plain(c: str) -> str:
    """What a character stands for: itself, an ASCII character, or nothing."""
    code = ord(c)
    if code < 0xA0:
        return c
    if 0xFF01 <= code <= 0xFF5E:
        return chr(code - 0xFEE0)
    if c in LOOK_ALIKES:
        return LOOK_ALIKES[c]
    kind = unicodedata.category(c)
    if kind == "Nd":
        return str(unicodedata.decimal(c))
    if kind == "Cf":
        return ""
    if kind == "Zs":
        return " "
    if kind == "Pd" or code == 0x2212:
        return "-"
    return c


class Rewrite:
    """A text under transducers: ``text`` and, per character, its source range."""

    def __init__(self, text: str):
        self.text, self.start, self.end = text, list(range(len(text))), list(range(1, len(text) + 1))

    def apply(self, edits: list[tuple[int, int, str]]):
        """Replace ranges [s, e) of the current text, in order. Each written character stands for the whole range."""
        if not edits:
            return
        text, start, end, past = [], [], [], 0
        for s, e, new in edits:
            text.append(self.text[past:s])
            start += self.start[past:s]
            end += self.end[past:s]
            text.append(new)
            if new:
                start += [self.start[s]] * len(new)
                end += [self.end[e - 1]] * len(new)
            past = e
        text.append(self.text[past:])
        self.text = "".join(text)
        self.start, self.end = start + self.start[past:], end + self.end[past:]


def _character_edits(text: str):
    return [(m.start(), m.end(), new) for m in _strange.finditer(text) if (new := _plain(m.group())) != m.group()]


def _spelled_edits(text: str):
    out = []
    for run in _run.finditer(text):
        items = list(_run_item.finditer(text, run.start(), run.end()))
        if sum(m.group().lower() in _spelled for m in items) < 3:
            continue
        past = items[0].start()
        for m in items:
            if m.start() > past:
                out.append((past, m.start(), ""))
            word = m.group().lower()
            out.append((m.start(), m.end(), _spelled.get(word) or {"dot": ".", "plus": "+"}.get(word) or word))
            past = m.end()
    # numerals keep one source range per digit
    return [(s + k, s + k + 1, c) if new.isdigit() and len(new) == e - s else (s, e, new)
            for s, e, new in out for k, c in (enumerate(new) if new.isdigit() and len(new) == e - s else [(0, new)])]


def _mixed_edits(text: str):
    out = []
    for m in _mixed.finditer(text):
        found = m.group()
        letters = sum(c in "OoIl" for c in found)
        if letters and letters <= 0.4 * sum(c.isalnum() for c in found):
            out += [(m.start() + k, m.start() + k + 1, "0" if c in "Oo" else "1") for k, c in enumerate(found) if c in "OoIl"]
    return out


def _address_edits(text: str):
    out = [(m.start(), m.end(), "@") for m in _bracket_at.finditer(text)]
    out += [(m.start(), m.end(), ".") for m in _bracket_dot.finditer(text)]
    return sorted(out)


def _domain_end(text: str, begin: int, end: int, explicit: bool, hidden_before: bool) -> int:
    """Where the domain in [begin, end) ends: its longest part that is one; 0 if there is none."""
    dots = list(_domain_dot.finditer(text, begin, end))
    plain = [d.group() == "." for d in dots]
    spelled = [d.group().strip().lower() == "dot" for d in dots]
    first = plain.index(True) if any(plain) else len(dots)
    after = next((k for k in range(first, len(dots)) if spelled[k]), len(dots))  # first spelled dot after a plain one
    hidden = plain.index(False) if not all(plain) else len(dots)
    for k in range(len(dots), 0, -1):
        stop = dots[k].start() if k < len(dots) else end
        known = text[dots[k - 1].end():stop].lower() in TOP_LEVELS
        if explicit:  # any label, unless words go on after a domain that is one already
            good = known or after >= k
        else:  # "name at host.tld" is prose
            good = (hidden < k or hidden_before) and (known or not (spelled[k - 1] or plain[k - 1]))
        if good:
            return stop
    return 0


def _name_start(text: str, end: int, past: int, hidden: dict[int, int]) -> int:
    """Start of the name that ends at ``end``: words joined by hidden dots, none before ``past``; the first
    one may hold plain dots. -1 if there is none."""
    found = -1
    while True:
        start, dotted = end, False
        while start > 0 and text[start - 1] in _local:
            start -= 1
            dotted |= text[start] == "."
            if start < past:
                return found
        if start == end:
            return found
        found = start
        if dotted or start not in hidden:
            return found
        end = hidden[start]


def _disguise_edits(text: str):
    """Addresses whose "@" and dots are each plain, bracketed or spelled, from each "@" outwards."""
    hidden = {_space.match(text, m.end()).end(): m.start() for m in _dot_head.finditer(text)}
    out, past, at = [], 0, _at.search(text)
    while at:
        start = _name_start(text, at.start(), past, hidden)
        domain = _domain_chain.match(text, at.end()) if start >= 0 else None
        if not domain:
            at = _at.search(text, at.start() + 1)
            continue
        before = [(d.start(), d.end(), ".") for d in _hidden_dot.finditer(text, start, at.start())]
        end = _domain_end(text, at.end(), domain.end(), at.group().strip().lower() != "at", bool(before))
        whole = [(at.start(), at.end(), "@")] if at.group() != "@" else []
        whole += [(d.start(), d.end(), ".") for d in _hidden_dot.finditer(text, at.end(), end)] if end else []
        if end and whole:  # a plain address takes no words before it
            out += whole + before
        past = end or at.end()
        at = _at.search(text, past)
    return sorted(out)


def added_spans(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Spans that only the deobfuscated text shows, in source offsets."""
    low = text.lower()
    strange = not text.isascii() and _strange.search(text)
    steps = [(strange, _character_edits)]
    steps.append((strange or (_some_spelled.search(" " + low) and _run.search(text)), _spelled_edits))
    steps.append((strange or _mixed_trigger.search(text), _mixed_edits))
    brackets = _brackets.search(text)
    steps.append((strange or brackets or _dot_word.search(text), _disguise_edits))
    steps.append((strange or brackets, _address_edits))
    if not any(wanted for wanted, _ in steps):
        return []
    work, changed = Rewrite(text), False
    for wanted, step in steps:
        edits = step(work.text) if wanted else []
        work.apply(edits)
        changed |= bool(edits)
    if not changed:
        return []
    found = {(kind, work.start[s], work.end[e - 1]) for kind, s, e in base_spans(work.text)}
    # base spans of a kind do not overlap: the last one that starts no later is the only one that can hold a span
    last = lambda k, s: base[bisect_right(base, (k, s, len(text))) - 1] if base else (-1, 0, 0)
    return sorted((k, s, e) for k, s, e in found if not ((b := last(k, s))[0] == k and b[1] <= s and e <= b[2]))


def spans_of(text: str | None) -> list[tuple[int, int, int, bool]]:
    """(kind, start, end, found by a base pattern), by kind, then start."""
    text = text or ""
    base = base_spans(text)
    return sorted([(*s, True) for s in base] + [(*s, False) for s in added_spans(text, base)])


def redacted(text: str | None, spans) -> str | None:
    """The text with every span (overlapping ones merged) replaced by its kind in brackets."""
    if not spans:
        return text
    out, past = [], 0
    for start, end, kind in sorted((s, e, k) for k, s, e, _ in spans):
        if start >= past:
            out += [text[past:start], f"[{KINDS[kind].upper()}]"]
        past = max(past, end)
    return "".join([*out, text[past:]])


SPANS_DDL = "array<struct<kind:string,start:long,end:long,base:boolean>>"
_spans_type = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())]))


def find(docs: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, ``spans`` by kind and start, and ``redacted``: the text without them."""
    rows = docs.select(*[F.col(c) for c in keep], F.col(text_col).alias("__text"))
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])

    def run(batches):
        for batch in batches:
            texts = batch.column(batch.num_columns - 1).to_pylist()
            spans = [spans_of(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in range(len(keep))),
                 pa.array([[{"kind": KINDS[k], "start": s, "end": e, "base": b} for k, s, e, b in x] for x in spans], _spans_type),
                 pa.array([redacted(t, x) for t, x in zip(texts, spans, strict=True)], pa.string())],
                [*keep, "spans", "redacted"])

    return rows.mapInArrow(run, f"{types}, spans {SPANS_DDL}, redacted string")


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts and hashes of the spans, one row per document."""
    return found.select(
        F.col(id_col),
        *[F.expr(f"cast(size(filter(spans, x -> x.base AND x.kind = '{k}')) AS long)").alias(f"n_{k}") for k in KINDS],
        F.expr("sha2(array_join(transform(filter(spans, x -> x.base), x -> concat(x.kind, ':', x.start, ':', x.end)), ','), 256)")
        .alias("base_sha256"),
        F.expr("array_join(transform(spans, x -> concat(x.kind, ':', x.start, ':', x.end)), ',')").alias("spans"),
        F.expr("cast(size(filter(spans, x -> NOT x.base)) AS long)").alias("n_added"))
