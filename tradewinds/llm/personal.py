"""Personal data and secrets: high-recall candidates, boosted trees, calibrated thresholds.

The base kinds (email, ip, card, phone) are found exactly as their patterns say, in time that is
linear in the text, and always stay. Several generators for each kind then propose further spans, which
may overlap: mail addresses spelled with "at" and "dot", IPv6, cards with other marks or grouping,
phone numbers without a plus sign, and a kind of its own, ``secret``: values that follow the name of a
credential, and long runs of letters and digits. Trees score each proposal by its format and its
context. They are trained on the driver on ``TRAIN_ROWS`` made-up texts, a fixed bound, that the same
generators search: a proposal is true if it is what was hidden there. Each form is hidden both as
personal data and as something else (a file digest, a version, a part number), so that the context
decides. A threshold for each kind is set on made-up texts that training didn't see, so that nearly all
that pass are true. Of overlapping spans that pass, the best stays.

Texts are read whole, one at a time, at any length; nothing is shuffled. Time and memory are linear in
the text, and in its spans but for their sorting.

Nulls and ties: a null text is empty and has no spans. Rows are independent, so repeated and null
doc_ids give a row each; of proposals with equal scores the first kind and place goes first. An empty
table gives an empty result. Other columns are never read.
"""

from __future__ import annotations

import hashlib
import ipaddress
import math
import random
import re
from bisect import bisect
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tradewinds.llm import boosting

KINDS = ("email", "ip", "card", "phone")
#: The base kinds, and those that only the method finds.
ALL_KINDS = (*KINDS, "secret")
TRAIN_ROWS = 12000
#: Share of the spans over a threshold that must be true when it is set.
PRECISION = 0.99
#: Proposals that are scored at a time.
SCORED = 4096

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_NUMBERS = re.compile(r"[0-9]+(?:\.[0-9]+)+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")

_GAP = r"[ ]?(?:\[at\]|\(at\)|\{at\}|<at>| at |@)[ ]?"
_DOT = r"[ ]?(?:\[dot\]|\(dot\)|\{dot\}|<dot>| dot |\.)[ ]?"
_NAMED = r"(?:pass(?:word|wd|phrase|code)?|pwd|pin|secret|token|(?:api|access|private|auth|license)[ _-]?key|key|bearer|credentials?|authorization)"


def _spelled(text: str, low: str) -> bool:
    return "at" in low and "dot" in low


def _any(*words: str) -> Callable[[str, str], bool]:
    return lambda text, low: any(w in low for w in words)


def _digits(text: str, low: str) -> bool:
    return _DIGIT.search(text) is not None


#: Generators beyond the base: kind, when to look, pattern; the last group is the span. Each is linear: what repeats is bounded.
GENERATORS = (
    ("email", _spelled, re.compile(rf"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{{1,64}}{_GAP}[A-Za-z0-9-]{{1,63}}(?:{_DOT}[A-Za-z0-9-]{{1,63}}){{0,3}}{_DOT}[A-Za-z]{{2,12}}(?![A-Za-z0-9])", re.I)),
    ("email", _any("(at)", "[at]"), re.compile(rf"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{{1,64}}[ ]?[\[(]at[\])][ ]?[A-Za-z0-9-]{{1,63}}(?:\.[A-Za-z0-9-]{{1,63}}){{1,4}}", re.I)),
    ("ip", _any("::"), re.compile(r"(?<![0-9A-Za-z:.])(?:[0-9A-Fa-f]{1,4}:){0,7}:(?:[0-9A-Fa-f]{1,4}:){0,6}[0-9A-Fa-f]{0,4}(?![0-9A-Za-z:])")),
    ("ip", _any(":"), re.compile(r"(?<![0-9A-Za-z:.])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:])")),
    ("card", _digits, re.compile(r"(?<![0-9A-Za-z.])[0-9]{4}[./_ -][0-9]{4}[./_ -][0-9]{4}[./_ -][0-9]{1,7}(?![0-9A-Za-z])")),
    ("card", _digits, re.compile(r"(?<![0-9A-Za-z.])[0-9]{4}[./_ -]?[0-9]{6}[./_ -]?[0-9]{5}(?![0-9A-Za-z])")),
    ("phone", _digits, re.compile(r"(?<![0-9A-Za-z+.,-])(?:00[1-9][0-9]{0,2}[ .-])?\(?0?[0-9]{2,4}\)?[ ./-][0-9]{3,4}[ .-][0-9]{3,5}(?![0-9A-Za-z]|[.,-][0-9])")),
    ("phone", _digits, re.compile(r"(?<![0-9A-Za-z+.,-])0[1-9](?:[ .-][0-9]{2}){4}(?![0-9A-Za-z]|[.,-][0-9])")),
    ("phone", _digits, re.compile(r"(?<![0-9A-Za-z+.,-])\([0-9]{2,5}\)[ ]?[0-9]{3,4}[ .-]?[0-9]{3,5}(?![0-9A-Za-z])")),
    ("secret", _any("pass", "pwd", "pin", "secret", "token", "key", "bearer", "credential", "authorization"), re.compile(rf"(?<![A-Za-z]){_NAMED}(?![A-Za-z0-9])[\"']?[ ]{{0,3}}(?::=|=>|[:=]|is|was)?[ ]{{0,3}}[\"'`]?(?P<span>[^\s\"'`,;<>]{{6,256}})", re.I)),
    ("secret", _digits, re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_-]{16,256}={0,2}(?![A-Za-z0-9+/_=-])")),
)


def luhn(digits: str) -> bool:
    """The check-sum of card numbers."""
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if k % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Places of mail addresses, leftmost first: each ``@`` is looked at once."""
    out, floor, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > floor and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        floor = found.end() if found else at + 1
        if found:
            out.append((start, found.end()))
        at = text.find("@", floor)
    return out


def ips(text: str) -> list[tuple[int, int]]:
    """Four numbers with dots between; a longer chain is read in fours from its start."""
    out = []
    for chain in _NUMBERS.finditer(text):
        numbers, at = chain.group().split("."), chain.start()
        for k in range(0, len(numbers) - 3, 4):
            four = numbers[k : k + 4]
            end = at + sum(map(len, four)) + 3
            if all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or 0) <= 255 for x in four):
                out.append((at, end))
            at = end + 1
    return out


def cards(text: str) -> list[tuple[int, int]]:
    out = []
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append(m.span())
    return out


def phones(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in _PHONE.finditer(text) if 9 <= sum(c.isdigit() for c in m.group()) <= 15]


def base_spans(text: str) -> dict[str, list[tuple[int, int]]]:
    """The base places of each kind."""
    has = _DIGIT.search(text)
    return {"email": emails(text) if "@" in text else [], "ip": ips(text) if has else [], "card": cards(text) if has else [], "phone": phones(text) if has and "+" in text else []}


#: Words before a span that speak for a kind, and such as speak against all.
_HINTS = {
    "email": ("mail", "contact", "write", "reach"),
    "ip": ("ip", "host", "server", "address", "from"),
    "card": ("card", "visa", "pay", "credit", "number"),
    "phone": ("tel", "phone", "call", "fax", "mobile", "dial"),
    "secret": ("password", "passwd", "pwd", "secret", "token", "key", "bearer", "credential", "login", "auth"),
}
_AGAINST = ("version", "isbn", "order", "page", "section", "chapter", "part", "invoice", "sku", "model", "code", "commit", "sha", "md5", "checksum", "digest", "uuid", "file", "build", "public")
_CONTEXT = 24
#: Ends of domains that are common.
_ENDS = frozenset("com org net edu gov io de fr es uk it nl ch at info eu".split())
_VOWELS = frozenset("aeiouAEIOU")


def _valid_ip(span: str) -> bool:
    try:
        return ipaddress.ip_address(span) is not None
    except ValueError:
        return False


def features(text: str, kind: str, start: int, end: int) -> list[float]:
    """Format and context of a span, as numbers."""
    span = text[start:end]
    n = len(span)
    digits = [c for c in span if "0" <= c <= "9"]
    letters = [c for c in span if c.isalpha()]
    upper = sum(c.isupper() for c in letters)
    marks = [c for c in span if not c.isalnum()]
    groups = [len(g) for g in re.findall("[0-9]+", span)]
    counts = Counter(span).values()
    sorts = [0 if c.isdigit() else 1 if c.islower() else 2 if c.isupper() else 3 for c in span]
    ahead = text[max(0, start - _CONTEXT) : start].lower()
    near = ahead.rstrip(" \"'`")[-1:]
    left, right = text[start - 1 : start], text[end : end + 1]
    first = re.match("[^0-9]*([0-9]{4})(?![0-9])", span)
    tail = re.search("[A-Za-z]+$", span)
    return [
        *(float(kind == k) for k in ALL_KINDS),
        float(n), float(len(digits)), float(len(marks)), float(len(set(marks))),
        float(len(groups)), float(max(groups, default=0)), float(min(groups, default=0)),
        float(bool(digits) and luhn("".join(digits))),
        float(bool(first) and 1900 <= int(first[1]) <= 2100),
        float("(" in span), float(span.startswith(("00", "(0", "0", "("))),
        float(any(h in ahead for h in _HINTS[kind])), float(any(h in ahead for h in _AGAINST)),
        float(left.isalnum()), float(right.isalnum()),
        float(left in "$€£#" and left != ""), float(right in "%°" and right != ""),
        float(len(set(digits))),
        len(digits) / n, upper / max(1, len(letters)), sum(c in _VOWELS for c in letters) / max(1, len(letters)),
        -sum(k / n * math.log2(k / n) for k in counts), sum(a != b for a, b in zip(sorts, sorts[1:], strict=False)) / n,
        float(all(c in "0123456789abcdefABCDEF" for c in span)), float(near in "=:" and near != ""), float(left in "\"'`" and left != ""),
        float(kind == "ip" and _valid_ip(span)), float(bool(tail) and tail[0].lower() in _ENDS),
        float(any(x in span for x in ("[at]", "(at)", "{at}", "<at>"))),
    ]


def proposals(text: str) -> list[tuple[str, int, int]]:
    """Spans that the generators propose, each once; they may overlap."""
    low = text.lower()
    out: dict[tuple[str, int, int], None] = {}
    for kind, may, pattern in GENERATORS:
        if may(text, low):
            named = "span" in pattern.groupindex
            for m in pattern.finditer(text):
                out[(kind, *(m.span("span") if named else m.span()))] = None
    return list(out)


def _made_up(rng: random.Random) -> tuple[str, tuple[str, int, int] | None]:
    """A text that hides a span of a kind as personal data, or one of the same forms that isn't any."""
    kind, true = rng.choice(ALL_KINDS), rng.random() < 0.5
    chars = lambda some, n: "".join(rng.choice(some) for _ in range(n))
    num = lambda n: chars("0123456789", n)
    word = lambda: chars("aeioubdlmnrst", rng.randrange(2, 10))
    hinted = rng.random() < 0.6
    hint = rng.choice(_HINTS[kind]) if true and hinted else word() if rng.random() < 0.6 or true else rng.choice(_AGAINST)
    lead, close = f"{hint}{rng.choice(['', ':', ' is'])} ", ""
    if kind == "email":
        plain = rng.random() < 0.5
        at, dot = (" at ", " dot ") if plain else (rng.choice(["[at]", "(at)", "{at}", " [at] ", " (at) "]), rng.choice(["[dot]", "(dot)", "{dot}", " [dot] ", "."]))
        name = rng.choice([f"{word()}.{word()}", f"{word()}{num(2)}", word()])
        end = rng.choice(sorted(_ENDS)) if true else rng.choice([word(), word(), "com"]) if plain else word()
        if true and plain and not hinted:
            name = f"{word()}.{word()}{num(2)}"
        if not true and not plain:
            at, dot = rng.choice([" at ", "@"]), rng.choice([" dot ", " (dot) "])
        span = f"{name}{at}{word()}{dot}{end}"
    elif kind == "ip":
        groups = [f"{rng.randrange(1 << 16):x}" for _ in range(8)]
        k, gone = rng.randrange(0, 6), rng.randrange(2, 6)
        short = ":".join(groups[:k]) + "::" + ":".join(groups[k + gone :])
        wrong = [":".join(num(2) for _ in range(8)), f"{word()[:1]}::", f"{num(2)}::{num(2)}", ":".join(num(1) for _ in range(8)), "::"]
        span = rng.choice([":".join(groups), ":".join(g.zfill(4) for g in groups), short]) if true else rng.choice(wrong)
    elif kind == "card":
        form = rng.choice([(4, 4, 4, 4), (4, 6, 5)])
        digits = rng.choice("3456") + num(sum(form) - 1)
        right = next(d for d in (digits[:-1] + c for c in "0123456789") if luhn(d))
        wrong = digits[:-1] + str((int(right[-1]) + rng.randrange(1, 10)) % 10)
        digits, mark = right if true or rng.random() < 0.1 else wrong, rng.choice("./_ -")
        span = mark.join(digits[sum(form[:k]) : sum(form[: k + 1])] for k in range(len(form)))
    elif kind == "phone":
        mark = rng.choice(" .-")
        forms = [f"({num(3)}) {num(3)}-{num(4)}", f"{rng.randrange(2, 10)}{num(2)}{mark}{num(3)}{mark}{num(4)}", f"0{num(3)}{mark}{num(3)}{mark}{num(4)}", f"00{rng.randrange(1, 99)} {num(3)} {num(3)} {num(4)}", mark.join([f"0{rng.randrange(1, 10)}", *(num(2) for _ in range(4))])]
        wrong = [f"{rng.randrange(1900, 2100)}-{num(3)}-{num(3)}", f"{num(3)} {num(3)} {num(3)}", f"{num(2)}/{num(3)}-{num(4)}", f"{num(4)}.{num(3)}.{num(3)}", f"({num(4)}) {num(3)} {num(3)}"]
        span = rng.choice(forms if true or hint in _AGAINST else wrong)
        if true and span.count(mark) == 2 and not hinted and span[0] not in "(0":
            lead = f"{rng.choice(_HINTS[kind])} "  # ten digits in threes mean little alone
    else:
        hexed, mixed, big = "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
        named = rng.choice(["password", "passwd", "pwd", "secret", "token", "api_key", "access key", "secret key", "auth key", "Bearer"])
        sign = rng.choice(["=", " = ", ": ", ":", "=>", " is "]) if named != "Bearer" else " "
        quote = rng.choice(["", '"', "'"])
        if true and rng.random() < 0.6:
            span = rng.choice([chars(hexed, rng.choice([12, 18, 24, 32, 40])), chars(mixed, rng.randrange(10, 44)), f"{word()}{num(3)}{rng.choice('!#$%')}{chars(mixed, 3)}", f"{word().title()}{num(4)}", f"{chars(mixed, 20)}/{chars(mixed, 20)}"])
            lead, close = f"{named}{sign}{quote}", quote
        elif true:
            span = rng.choice([f"{chars(big[:26], 4)}{chars(big, 16)}", f"{word()[:2]}_{chars(mixed, rng.randrange(20, 40))}", f"{word()[:2]}-{word()[:4]}-{chars(mixed, 32)}", chars(mixed, rng.randrange(28, 48)), f"ey{chars(mixed, 30)}"])
        elif rng.random() < 0.4:
            lead, span = f"{named}{rng.choice([sign, ' '])}", rng.choice([f"{word()}{word()}", f"{word()}s", f"{word()}_{word()}({word()})", "required", "protected", f"{word()}.{word()}", f"{num(6)}0", "********", f"${{{word().upper()}}}", f"<{word()}>"])
        else:
            lead = rng.choice([f"{rng.choice(['commit', 'sha', 'sha256', 'md5', 'checksum', 'digest', 'uuid', 'file', 'build', 'public key'])} ", lead])
            span = rng.choice([chars(hexed, rng.choice([32, 40, 64])), "-".join(chars(hexed, k) for k in (8, 4, 4, 4, 12))]) if lead.split()[0] in _AGAINST else rng.choice([f"{word()}-{word()}-{word()}-{num(4)}", f"{word()}{word()}{word()}{num(2)}", num(rng.randrange(16, 30)), f"/{word()}/{word()}/{word()}{num(2)}", f"{word().upper()}_{word().upper()}_{word().upper()}_{num(2)}", f"{num(4)}-{num(2)}-{num(2)}T{num(6)}", f"{word()}/{word()}_{num(8)}", "-" * 30 + num(1)])
    head = " ".join(word() for _ in range(rng.randrange(0, 4))) + " " + lead
    return head + span + close + rng.choice([" ", ".", ",", "\n"]) + word(), (kind, len(head), len(head) + len(span)) if true else None


@cache
def trained(seed: int = 7) -> tuple[boosting.Boosted, dict[str, float]]:
    """The trees, and the threshold of each kind."""
    rng = random.Random(seed)
    x, y, kinds, cut = [], [], [], 0
    for k in range(TRAIN_ROWS):
        text, hidden = _made_up(rng)
        for c in proposals(text):
            x.append(features(text, *c))
            y.append(float(c == hidden))
            kinds.append(c[0])
        if k == TRAIN_ROWS * 2 // 3:
            cut = len(x)
    x, y, kinds = np.array(x), np.array(y), np.array(kinds)
    model = boosting.fit(x[:cut], y[:cut], rounds=80)
    score, truth, kinds = model.score(x[cut:]), y[cut:], kinds[cut:]
    cuts = {}
    for kind in ALL_KINDS:
        s, t = score[kinds == kind], truth[kinds == kind]
        order = np.argsort(-s, kind="stable")
        right = np.cumsum(t[order]) / np.arange(1, len(order) + 1)
        good = np.flatnonzero(right >= PRECISION)
        cuts[kind] = max(0.5, float(s[order][good[-1]])) if len(good) else 1.1
    return model, cuts


def added_spans(text: str, base: dict[str, list[tuple[int, int]]], model: boosting.Boosted, cuts: dict[str, float]) -> list[tuple[str, int, int]]:
    """Proposals that pass their threshold and overlap neither a base span nor a better one."""
    found = proposals(text)
    if not found:
        return []
    taken = sorted(s for spans in base.values() for s in spans)
    starts, reach, ends = [a for a, _ in taken], 0, []
    for _, b in taken:  # base spans of two kinds may overlap
        reach = max(reach, b)
        ends.append(reach)
    found = [c for c in found if (k := bisect(starts, c[2] - 1)) == 0 or ends[k - 1] <= c[1]]
    if not found:
        return []
    scores = np.concatenate([model.score(np.array([features(text, *c) for c in found[k : k + SCORED]])) for k in range(0, len(found), SCORED)])
    out, first, last = [], [], []
    for score, (kind, start, end) in sorted(zip(-scores, found, strict=True)):
        if -score < cuts[kind]:
            continue
        k = bisect(first, end - 1)  # those that stay don't overlap: only the one before can reach in
        if k == 0 or last[k - 1] <= start:
            first.insert(k, start)
            last.insert(k, end)
            out.append((kind, start, end))
    return out


def find(text: str, model: boosting.Boosted, cuts: dict[str, float]) -> tuple[dict[str, list], list[tuple[str, int, int]]]:
    """Base places by kind, and all spans in the order of kinds and starts."""
    base = base_spans(text)
    spans = [(k, a, b) for k in KINDS for a, b in base[k]] + added_spans(text, base, model, cuts)
    return base, sorted(spans, key=lambda s: (ALL_KINDS.index(s[0]), s[1], s[2]))


def redact(text: str, spans: Iterable[tuple[str, int, int]]) -> str:
    """The text with each span replaced by its kind; overlapping spans by the first's."""
    out, at = [], 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        if end > at:
            out += [text[at : max(at, start)], f"<{kind}>" if start >= at else ""]
            at = end
    return "".join([*out, text[at:]])


def _joined(spans: Iterable[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def personal_spans(docs: DataFrame) -> DataFrame:
    """``doc_id, base, spans, redacted``: the base places and all spans, as ``kind:start:end``, and the text without them."""
    model, cuts = trained()
    schema = pa.schema([("doc_id", pa.int64()), ("base", pa.list_(pa.string())), ("spans", pa.list_(pa.string())), ("redacted", pa.string())])

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                base, spans = find(text or "", model, cuts)
                rows.append({"doc_id": doc_id, "base": [f"{k}:{s}:{e}" for k in KINDS for s, e in base[k]], "spans": [f"{k}:{s}:{e}" for k, s, e in spans], "redacted": redact(text or "", spans)})
            yield pa.RecordBatch.from_pylist(rows, schema)

    return docs.select("doc_id", "text").mapInArrow(task, "doc_id long, base array<string>, spans array<string>, redacted string")


def personal_digests(docs: DataFrame) -> DataFrame:
    """Counts by kind, the digest of the base places and all spans of each row."""
    model, cuts = trained()
    schema = pa.schema([("doc_id", pa.int64()), *((f"n_{k}", pa.int64()) for k in KINDS), ("base_sha256", pa.string()), ("spans", pa.string())])

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                base, spans = find(text or "", model, cuts)
                said = _joined((k, s, e) for k in KINDS for s, e in base[k])
                rows.append({"doc_id": doc_id, **{f"n_{k}": len(base[k]) for k in KINDS}, "base_sha256": hashlib.sha256(said.encode()).hexdigest(), "spans": _joined(spans)})
            yield pa.RecordBatch.from_pylist(rows, schema)

    return docs.select("doc_id", "text").mapInArrow(task, "doc_id long, " + ", ".join(f"n_{k} long" for k in KINDS) + ", base_sha256 string, spans string")
