"""Secret scans: fixed patterns, and guess costs of values in credential contexts.

Base kinds, found leftmost and non-overlapping each: ``assign`` (a credential
name, ``:`` or ``=``, a value of 6 or more characters), ``access`` (AKIA keys of
20 or more) and ``hex`` (lower-case hexadecimal runs of 24 or more).

The method adds ``value``: what follows a credential name in wider contexts
(more names, any characters up to white space or, with white space, to the
closing quote), if it would take an attacker at least ``10**MIN_COST`` guesses.
Prose says "the password is required", so a value of letters alone that follows
a bare ``is`` needs ``10**PROSE_COST``. A value of which one base span covers all
is not listed again; else it may overlap base spans. Values that base spans
cover are costed too: ``n_weak`` counts the values of ``assign`` that take fewer
than ``10**MIN_COST`` guesses, placeholders and weak passwords among them.
The cost of a value is that of its cheapest segmentation into dictionary words
(rank, case, letter substitutions, backwards), dates, repeats of a unit, keyboard walks
and brute-force characters, found by dynamic programming over positions; costs
are logarithms to base 10 and add up, each segment adds ``SEGMENT``. It takes
time linear in the value, however long.

Spans are code points of the whole text, end exclusive, in order of start and
then of kind as listed. Defined results: a null or empty text has no spans;
repeated rows are scanned each; an empty table stays empty; only doc_id and text
are read.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from cobasket.llm.text import chunks

KINDS = ("assign", "access", "hex", "value")
MIN_COST = 9.0
PROSE_COST = 24.0
SEGMENT = 0.6
MIN_ASSIGN = 6
MIN_VALUE = 6

# The base patterns.
ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I)
ACCESS = re.compile(rb"AKIA[A-Z0-9]{16,}")  # of 20 or more characters
HEX = re.compile(rb"[0-9a-f]{24,}")
_NAMES = (b"passw", b"secret", b"token", b"apikey", b"api_key")
CONTEXT = re.compile(
    rb"""(?:pass ?word|passwd|pass ?phrase|\bpwd|\bpass|secret|token|api[_ -]?key|access[_ -]?key|private[_ -]?key|credentials?|auth(?:orization)?|bearer)"""
    rb"""["']?(?:\x20*(?:[:=]|=>|(?P<prose>\bis\b))\x20*|\x20+bearer\x20+)(?:"([^"\n]+)"|'([^'\n]+)'|([^\s"',;]+))""",
    re.I,
)
_CONTEXT_NAMES = (*_NAMES, b"pass", b"pwd", b"api", b"access", b"private", b"credential", b"auth", b"bearer")

# Common passwords and words in them, most common first.
WORDS = (
    "password qwerty dragon baseball football letmein monkey master shadow sunshine princess welcome admin login superman batman trustno1 "
    "iloveyou michael jordan access love secret summer winter spring autumn hello freedom whatever starwars computer pepper ginger "
    "soccer hockey killer george charlie andrew michelle jessica daniel thomas robert matthew ashley nicole hannah buster tigger "
    "cookie flower silver golden orange purple yellow green black white blue red test user root guest changeme default system server "
    "database example sample token pass word key code data home house work office school mother father sister brother family friend "
    "money magic music dance party happy lucky angel devil heaven night day sun moon star fire water earth wind stone river mountain "
    "january february march april june july august september october november december monday tuesday wednesday thursday friday"
).split()
RANK = {w: i + 1 for i, w in enumerate(WORDS)}
_EITHER_WAY = {*WORDS, *(w[::-1] for w in WORDS)}
_LONGEST = max(map(len, WORDS))
_PLAIN = str.maketrans("4@831!0$57+", "aabeiiosstt")
_ROWS = ("`1234567890-=", "qwertyuiop[]\\", "asdfghjkl;'", "zxcvbnm,./")
_SHIFTED = ("~!@#$%^&*()_+", "QWERTYUIOP{}|", 'ASDFGHJKL:"', "ZXCVBNM<>?")
_KEY = {c: (r, i) for rows in (_ROWS, _SHIFTED) for r, row in enumerate(rows) for i, c in enumerate(row)}
_DATE = re.compile(r"(?:(?:19|20)\d\d([-/._]?)(?:0?[1-9]|1[0-2])\1(?:0[1-9]|[12]\d|3[01]|[1-9])|(?:0?[1-9]|[12]\d|3[01])([-/._]?)(?:0?[1-9]|1[0-2])\2(?:19|20)\d\d|(?:19|20)\d\d)")


def word_cost(part: str) -> float | None:
    """Of a dictionary word: rank, spellings by case, substituted letters, and a factor of 2 if it is spelt backwards."""
    lower = part.lower()
    plain = lower.translate(_PLAIN)
    rank = RANK.get(lower) or RANK.get(plain) or 2 * RANK.get(lower[::-1], 0) or 2 * RANK.get(plain[::-1], 0)
    if not rank:
        return None
    upper = sum(c.isupper() for c in part)
    cost = math.log10(rank)
    if upper:
        cost += math.log10(2 if upper == len(part) or (upper == 1 and (part[0].isupper() or part[-1].isupper())) else math.comb(len(part), upper))
    changed = sum(a != b for a, b in zip(lower, plain, strict=True)) if lower not in RANK and lower[::-1] not in RANK else 0
    return cost + changed * math.log10(2)


def char_cost(c: str) -> float:
    """Of one brute-force character: the size of its class."""
    if "0" <= c <= "9":
        return 1.0
    if "a" <= c <= "z" or "A" <= c <= "Z":
        return math.log10(26)
    return math.log10(33 if c < "\x7f" else 100)


def spans_of(value: str) -> list[tuple[int, int, float, str]]:
    """Segments other than brute force: from, to, cost and kind."""
    n, found = len(value), []
    lower = "".join(c.lower()[:1] for c in value)  # as long as the value
    plain = lower.translate(_PLAIN)
    for i in range(n):
        for j in range(i + 3, min(n, i + _LONGEST) + 1):
            if lower[i:j] in _EITHER_WAY or plain[i:j] in _EITHER_WAY:
                cost = word_cost(value[i:j])
                if cost is not None:
                    found.append((i, j, cost, "word"))
    for i in range(n):
        if value[i].isdigit():
            m = _DATE.match(value, i)
            if m:
                year = re.search(r"(?:19|20)\d\d", m[0])
                away = math.log10(max(20, abs(int(year[0]) - 2000)))
                days = math.log10(365) if len(m[0]) > 4 else 0.0
                found.append((i, m.end(), away + days + (0.6 if m[1] or m[2] else 0.0), "date"))
    i = 0
    while i < n - 3:  # maximal keyboard walks of 4 or more keys
        j, turns, last = i + 1, 1, None
        while j < n and value[j - 1] in _KEY and value[j] in _KEY:
            (r0, c0), (r1, c1) = _KEY[value[j - 1]], _KEY[value[j]]
            move = (r1 - r0, c1 - c0)
            if move == (0, 0) or abs(move[0]) > 1 or abs(move[1]) > 1:
                break
            turns += last is not None and move != last
            last, j = move, j + 1
        if j - i >= 4:
            found.append((i, j, math.log10(47 * (j - i)) + turns * math.log10(4.6), "walk"))
        i = max(j - 1, i + 1)
    return found


def repeats(value: str, longest: int = 8) -> list[tuple[int, int, int]]:
    """Maximal runs of a repeated unit: from, to and the unit's length."""
    n, found = len(value), []
    for unit in range(1, longest + 1):
        i = unit
        while i < n:
            j = i
            while j < n and value[j] == value[j - unit]:
                j += 1
            if j - i >= max(unit, 2):
                found.append((i - unit, j, unit))
            i = j + 1
    return found


def guess_cost(value: str) -> float:
    """log10 of the guesses that the cheapest segmentation of a value takes."""
    n = len(value)
    ends: list[list[tuple[int, float]]] = [[] for _ in range(n + 1)]
    for i, j, cost, _ in spans_of(value):
        ends[j].append((i, cost + SEGMENT))
    for i, j, unit in repeats(value):
        brute = sum(map(char_cost, value[i : i + unit]))
        word = word_cost(value[i : i + unit])
        count = (j - i) // unit
        ends[i + count * unit].append((i, (brute if word is None else min(brute, word)) + math.log10(count) + SEGMENT))
    # best[k]: cheapest cost of value[:k]; the second one ends in an open brute-force run
    best, brute = [0.0] * (n + 1), [math.inf] * (n + 1)
    for k in range(1, n + 1):
        brute[k] = min(brute[k - 1], best[k - 1] + SEGMENT) + char_cost(value[k - 1])
        best[k] = min([brute[k], *(best[i] + cost for i, cost in ends[k])])
    return best[n]


def weak_values(text: bytes) -> int:
    """How many values of ``assign`` spans an attacker would guess within ``10**MIN_COST``."""
    found = [m[2] for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_ASSIGN] if any(x in text.lower() for x in _NAMES) else []
    return sum(guess_cost(v.decode()) < MIN_COST for v in found)


def enough(value: str, prose: bool) -> float | None:
    """The cost of a value, if it is one to report."""
    if len(value) < MIN_VALUE:
        return None
    cost = guess_cost(value)
    return cost if cost >= (PROSE_COST if prose and value.rstrip(".!?:)").isalpha() else MIN_COST) else None


def scan(text: bytes) -> tuple[list[tuple[int, int, int]], list[float]]:
    """(start, kind's number, end) in bytes, sorted, and the costs of the added values."""
    lower = text.lower()
    base = []
    if any(x in lower for x in _NAMES):
        base += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= MIN_ASSIGN]
    if b"AKIA" in text:
        base += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    base += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    added, costs = [], []
    if any(x in lower for x in _CONTEXT_NAMES):
        taken = sorted((a, b) for a, _, b in base)
        at = reach = 0
        for m in CONTEXT.finditer(text):
            a, b = next(m.span(k) for k in (2, 3, 4) if m.start(k) >= 0)
            while at < len(taken) and taken[at][0] <= a:
                reach = max(reach, taken[at][1])
                at += 1
            if reach >= b:
                continue
            cost = enough(text[a:b].decode("utf-8", "replace"), m["prose"] is not None)
            if cost is not None:
                added.append((a, 3, b))
                costs.append(cost)
    return sorted(base + added), costs


def code_points(text: bytes, places: list[int]) -> dict[int, int]:
    """Code points before each of some byte positions."""
    out, at, seen = {}, 0, 0
    for p in sorted(set(places)):
        seen += len(text[at:p].decode("utf-8", "replace"))
        out[p], at = seen, p
    return out


def find_secrets(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_value, the highest cost of an added value, and n_weak."""
    kind = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_value long, max_cost double, n_weak long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in chunks(batches):
            out: list[list] = [[] for _ in range(8)]
            for text in texts:
                found, costs = scan(text)
                place = code_points(text, [p for a, _, b in found for p in (a, b)])
                named = [(k, f"{KINDS[k]}:{place[a]}:{place[b]}") for a, k, b in found]
                base = ",".join(s for k, s in named if k < 3)
                counts = [sum(k == n for k, _ in named) for n in range(4)]
                row = [*counts[:3], hashlib.sha256(base.encode()).hexdigest(), ",".join(s for _, s in named), counts[3], max(costs, default=None), weak_values(text)]
                for column, value in zip(out, row, strict=True):
                    column.append(value)
            types = [pa.int64()] * 3 + [pa.string()] * 2 + [pa.int64(), pa.float64(), pa.int64()]
            columns = [batch.column(0), *(pa.array(c, t) for c, t in zip(out, types, strict=True))]
            yield pa.record_batch(columns, names=[f.strip().split(" ")[0] for f in kind.split(",")])

    return docs.select("doc_id", "text").mapInArrow(run, kind)
