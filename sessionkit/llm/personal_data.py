"""Personal data in whole texts: patterns, and a tagger that adds to them.

*Base.*  Emails, ip addresses, card and phone numbers by their patterns, leftmost
and non-overlapping per kind; a match that fails its check is dropped without a
retry.  Each kind is found around its anchor (the at sign, a run of digits, the
plus sign), so that time is linear in the text.

*Labels.*  The tagger (``tagger.py``) learns from windows around base spans of
the corpus and from windows with digits or at signs but without a base span.
Of each kind, and of the windows without one, the ``per_kind`` distinct windows
of smallest hash are taken (a documented bound); each labelled window is also
shown with its span rewritten in a form that the patterns leave out.

*Windows.*  Texts are cut into windows of ``WINDOW`` characters, each half over
the next.  A span must hold a digit, an at sign or a bracketed "at", so windows
without any can hold none and are not run.  All others are decoded in batches.

*Reconciling.*  Spans that the edge of a window cuts are joined with those of
the overlapping window; then, per text, of all candidates that pass the check
of their kind and touch no base span, the set without overlaps whose windows
give the greatest sum of weights stays (more windows and a place further from
their edges weigh more).  Base spans always stay.

Null texts count as empty: no spans.  Offsets are code points, the end is
exclusive.  Repeated rows are answered each; a null id stays null; extra columns
are not read; an empty table gives no rows; without labels nothing is added.
"""

from __future__ import annotations

import heapq
import re
import zlib
from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import only, text_groups
from .tagger import Tagger

KINDS = ["email", "ip", "card", "phone"]
EMAIL, IP, CARD, PHONE = range(4)
WINDOW, STEP = 128, 64
BATCH = 512
PER_KIND = 150
#: Windows per training step, and steps.
TRAIN_BATCH, STEPS = 64, 220

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_NUMBER = re.compile(r"[0-9]+(?:[\x20-][0-9]+)*")
_PLUS = re.compile(r"\+[0-9]([\x20().0-9-]+)")
_MARK = re.compile(r"[0-9@]|[(\[] ?at ?[)\]]")
_NOT_DIGIT = re.compile(r"[^0-9]+")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _emails(text: str):
    free = 0  # end of the match before
    at = text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            free = m.end()
            yield start, free
        free = max(free, at + 1)  # no local part reaches over an at sign
        at = text.find("@", free)


def _ips(text: str):
    for m in _DOTTED.finditer(text):
        parts, start = m.group().split("."), m.start()
        for i in range(0, len(parts) - 3, 4):
            end = start + sum(map(len, parts[i:i + 4])) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in parts[i:i + 4]):
                yield start, end
            start = end + 1


def _cards(text: str):
    for m in _NUMBER.finditer(text):
        if m.end() - m.start() >= 13:
            digits = _NOT_DIGIT.sub("", m.group())
            if 13 <= len(digits) <= 19 and luhn(digits):
                yield m.span()


def _phones(text: str):
    for m in _PLUS.finditer(text):
        rest = m.group(1).rstrip("\x20().-")
        if len(rest) >= 2 and 9 <= 1 + len(_NOT_DIGIT.sub("", rest)) <= 15:
            yield m.start(), m.start() + 2 + len(rest)


def base_spans(text: str) -> list:
    """(kind, start, end) of the patterns, by kind, then start."""
    out = []
    if "@" in text:
        out += [(EMAIL, *s) for s in _emails(text)]
    if _MARK.search(text):
        for kind, find in ((IP, _ips), (CARD, _cards), (PHONE, _phones)):
            out += [(kind, *s) for s in find(text)]
    return out


# ------------------------------------------------------------------- windows
#: Character classes: 0 beyond the text, printable ASCII one each, then line
#: ends and tabs, Latin letters, other white space, all else.
CLASSES = 100
_CLASS = np.full(0x3001, 99, dtype=np.uint8)
_CLASS[32:127] = np.arange(1, 96)
_CLASS[[9, 10, 11, 12, 13]] = 96
_CLASS[0xC0:0x250] = 97
_CLASS[[0xD7, 0xF7]] = 99
_CLASS[[0x85, 0xA0, 0x1680, *range(0x2000, 0x200b), 0x2028, 0x2029, 0x202f, 0x205f, 0x3000]] = 98


def char_classes(text: str, length: int = WINDOW) -> np.ndarray:
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    out = np.zeros(length, dtype=np.uint8)
    out[:len(codes)] = _CLASS[np.minimum(codes, len(_CLASS) - 1)]
    return out


def window_starts(text: str) -> list:
    """Where the windows begin that hold a mark."""
    last = max(0, -(-(len(text) - WINDOW) // STEP))  # the window that reaches the end
    found, m = set(), _MARK.search(text)
    while m:
        w = min(m.start() // STEP, last)
        found.update(x for x in (w - 1, w) if 0 <= x <= last and m.start() < x * STEP + WINDOW)
        m = _MARK.search(text, max((w + 1) * STEP, m.start() + 1))
    return [w * STEP for w in sorted(found)]


def tag_spans(tags: np.ndarray) -> list:
    """(kind, start, end) of one window's tags."""
    out, begin = [], None
    where = np.flatnonzero(tags)
    for i in where.tolist():
        t = int(tags[i])
        kind = (t - 1) // 2
        if t % 2 == 0 and out and out[-1][0] == kind and out[-1][2] == i:
            out[-1][2] = i + 1
        else:
            out.append([kind, i, i + 1])
    return [tuple(s) for s in out]


# ------------------------------------------------------- checks of added spans
_DOT = r"(?:\.|\x20?\[\.\]\x20?|\x20?\(\.\)\x20?|\x20\.\x20?|\x20?\[dot\]\x20?|\x20?\(dot\)\x20?)"
_AT = r"(?:@|\x20?@\x20?|\x20?[\[(]\x20?at\x20?[\])]\x20?)"
_SHAPES = {
    EMAIL: re.compile(rf"[\w.%+-]+{_AT}[\w-]+(?:{_DOT}[\w-]+)+"),
    IP: re.compile(rf"([0-9]+){_DOT}([0-9]+){_DOT}([0-9]+){_DOT}([0-9]+)"),
    CARD: re.compile(r"[0-9]+(?:[\x20./ -]{1,2}[0-9]+)*"),
    PHONE: re.compile(r"\+?\(?[0-9]+(?:[\x20()./ -]{1,2}[0-9]+)+"),
}


def passes(text: str, kind: int, start: int, end: int) -> bool:
    """Whether a tagged span has the shape and digits of its kind and no letter
    or digit goes on at either side."""
    part = text[start:end]
    if (start and text[start - 1].isalnum()) or (end < len(text) and text[end].isalnum()):
        return False
    m = _SHAPES[kind].fullmatch(part)
    if not m:
        return False
    digits = _NOT_DIGIT.sub("", part)
    if kind == IP:
        return all(len(p) <= 3 and int(p) <= 255 for p in m.groups())
    if kind == CARD:
        return 13 <= len(digits) <= 19 and luhn(digits)
    return kind == EMAIL or 9 <= len(digits) <= 15


# ----------------------------------------------------------------- reconciling
def reconcile(text: str, decoded: list, base: list) -> list:
    """Spans to add, from (window start, spans within the window) and the base
    spans of the text."""
    weights: dict = {}
    cut = []
    for w, spans in decoded:
        stop = w + WINDOW
        for kind, a, b in spans:
            a, b = a + w, min(b + w, len(text))
            left, right = a == w and w > 0, b == stop and stop < len(text)
            if left or right:
                cut.append((kind, a, b, left, right))
            else:
                room = min(a - w if w else STEP, stop - b if stop < len(text) else STEP, STEP)
                weights[kind, a, b] = weights.get((kind, a, b), 0.0) + 1 + room / STEP
    joined: list = []
    for kind, a, b, left, right in sorted(cut):
        if joined and joined[-1][0] == kind and a <= joined[-1][2]:
            top = joined[-1]
            top[4] = right if b > top[2] else top[4] and right if b == top[2] else top[4]
            top[2] = max(top[2], b)
        else:
            joined.append([kind, a, b, left, right])
    for kind, a, b, left, right in joined:
        if not (left or right):
            weights.setdefault((kind, a, b), 1.0)
    taken = sorted((a, b) for _, a, b in base)
    starts, reach, top = [a for a, _ in taken], [], 0
    for _, b in taken:
        top = max(top, b)
        reach.append(top)
    clear = lambda a, b: not (i := bisect_right(starts, b - 1)) or reach[i - 1] <= a
    spans = sorted((s for s in weights if s[1] < s[2] and clear(s[1], s[2]) and passes(text, *s)),
                   key=lambda s: (s[2], s))
    # weighted interval scheduling
    ends = [s[2] for s in spans]
    best = [0.0]
    for i, s in enumerate(spans):
        best.append(max(best[-1], weights[s] + best[bisect_right(ends, s[1], 0, i)]))
    out, i = [], len(spans)
    while i:
        s = spans[i - 1]
        if best[i] > best[i - 1]:
            out.append(s)
            i = bisect_right(ends, s[1], 0, i - 1)
        else:
            i -= 1
    return out


# ---------------------------------------------------------------------- labels
def variant(kind: int, span: str, pick: int) -> str:
    """The span written in a way that its pattern leaves out."""
    if kind == EMAIL:
        name, host = span.split("@", 1)
        return [f"{name} [at] {host}", f"{name} @ {host}", f"{name} (at) {host.replace('.', '[.]')}",
                f"{name}@{host.replace('.', '[.]')}"][pick % 4]
    if kind == IP:
        return span.replace(".", ["[.]", " . ", "(.)"][pick % 3])
    digits = _NOT_DIGIT.sub("", span)
    if kind == CARD:
        return [".", "/", "  "][pick % 3].join(digits[i:i + 4] for i in range(0, len(digits), 4))
    own = digits[-10:]
    return [f"({own[:3]}) {own[3:6]}-{own[6:]}", f"{own[:3]}-{own[3:6]}-{own[6:]}",
            f"{own[:3]}.{own[3:6]}.{own[6:]}", f"({own[:3]}) {own[3:6]} {own[6:]}"][pick % 4]


def _tags(spans: list, start: int) -> np.ndarray:
    out = np.zeros(WINDOW, dtype=np.int8)
    for kind, a, b in spans:
        a, b = a - start, b - start
        if b > 0 and a < WINDOW:
            out[max(a, 0):b] = 2 * kind + 2
            if a >= 0:
                out[a] = 2 * kind + 1
    return out


def _examples(text: str):
    """(stratum, hash, window text, tags, rewritten text, its tags)."""
    if not _MARK.search(text):
        return
    base = base_spans(text)
    lone = [s for i, s in enumerate(base) if not any(
        a < s[2] and s[1] < b for j, (_, a, b) in enumerate(base) if j != i)] if len(base) <= 50 else []
    for kind, a, b in lone:
        if b - a > WINDOW // 2:
            continue
        h = zlib.crc32(text[max(0, a - 64):b + 64].encode("utf-8", "surrogatepass"))
        start = max(0, a - h % (WINDOW - (b - a)))
        other = variant(kind, text[a:b], h >> 8)
        moved = [(k, x + (len(other) - (b - a)) * (x >= b), y + (len(other) - (b - a)) * (y > a))
                 for k, x, y in lone]
        yield (kind, h, text[start:start + WINDOW], _tags(lone, start).tobytes(),
               (text[:a] + other + text[b:b + WINDOW])[start:start + WINDOW],
               _tags(moved, start).tobytes())
    covered = sorted((a, b) for _, a, b in base)
    for w in window_starts(text):
        if not any(a < w + WINDOW and w < b for a, b in covered[:50]) and len(covered) <= 50:
            part = text[w:w + WINDOW]
            none = bytes(WINDOW)
            yield (len(KINDS), zlib.crc32(part.encode("utf-8", "surrogatepass")), part, none, part, none)


LABEL_SCHEMA = "stratum int, hash bigint, text binary, tags binary, other binary, other_tags binary"


def labelled_windows(docs: DataFrame, per_kind: int = PER_KIND, text_col: str = "text") -> list:
    """At most ``per_kind`` rows of each kind and of windows without one."""
    def run(batches):
        least: dict = {}  # stratum -> heap of the smallest hashes, greatest on top
        for b in batches:
            for text in b.column(0).to_pylist():
                for e in _examples(text or ""):
                    heap = least.setdefault(e[0], [])
                    item = (-e[1], e)
                    if len(heap) < per_kind:
                        if item not in heap:
                            heapq.heappush(heap, item)
                    elif item > heap[0] and item not in heap:
                        heapq.heapreplace(heap, item)
        rows = [e for heap in least.values() for _, e in heap]
        enc = lambda s: s if isinstance(s, bytes) else s.encode("utf-8", "surrogatepass")
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int64()),
             *(pa.array([enc(r[i]) for r in rows], pa.binary()) for i in range(2, 6))],
            names=[x.split()[0] for x in LABEL_SCHEMA.split(", ")])
    found = materialize(only(docs, text=text_col).mapInArrow(run, LABEL_SCHEMA).distinct(), "labelled")
    out = []
    for stratum in range(len(KINDS) + 1):
        out += found.filter(F.col("stratum") == stratum).orderBy("hash", "text", "tags").limit(per_kind).collect()
    return out


def fit(docs: DataFrame, per_kind: int = PER_KIND, steps: int = STEPS,
        text_col: str = "text") -> dict | None:
    """The parameters of a tagger trained on the labelled windows, or None
    where the corpus has no base span."""
    rows = labelled_windows(docs, per_kind, text_col)
    if not any(r["stratum"] < len(KINDS) for r in rows):
        return None
    pairs = {(bytes(t), bytes(g)) for r in rows
             for t, g in ((r["text"], r["tags"]), (r["other"], r["other_tags"]))}
    pairs = sorted(pairs)
    x = np.stack([char_classes(t.decode("utf-8", "surrogatepass")) for t, _ in pairs])
    y = np.stack([np.frombuffer(g, dtype=np.int8) for _, g in pairs])
    tagger = Tagger(CLASSES, len(KINDS))
    tagger.train(x, y, epochs=max(1, steps * TRAIN_BATCH // len(x)), batch=TRAIN_BATCH)
    return tagger.params


def added_spans(texts: list, bases: list, tagger: Tagger) -> list:
    """Per text, the spans that the tagger adds."""
    windows = [(i, w) for i, t in enumerate(texts) for w in window_starts(t)]
    decoded: dict = {}
    for a in range(0, len(windows), BATCH):
        part = windows[a:a + BATCH]
        x = np.stack([char_classes(texts[i][w:w + WINDOW]) for i, w in part])
        for (i, w), tags in zip(part, tagger.decode(x)):
            if tags.any():
                decoded.setdefault(i, []).append((w, tag_spans(tags)))
    return [reconcile(t, decoded[i], bases[i]) if i in decoded else []
            for i, t in enumerate(texts)]


SPAN = pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("stop", pa.int64()),
                  ("base", pa.bool_())])
SPAN_SCHEMA = "doc_id bigint, spans array<struct<kind: int, start: bigint, stop: bigint, base: boolean>>"


def find_personal_data(docs: DataFrame, params: dict | None, id_col: str = "doc_id",
                       text_col: str = "text") -> DataFrame:
    """Per row: doc_id and its spans (kind as a number of ``KINDS``, start, stop,
    whether the patterns found it), by kind, then start."""
    def run(batches):
        tagger = params and Tagger(CLASSES, len(KINDS), params=params).narrowed()
        for b in batches:
            texts = [t or "" for t in b.column("text").to_pylist()]
            spans = []
            for lo, hi in text_groups(texts):
                part = texts[lo:hi]
                bases = [base_spans(t) for t in part]
                more = added_spans(part, bases, tagger) if tagger else [[]] * len(part)
                spans += [[{"kind": k, "start": a, "stop": z, "base": own} for k, a, z, own in sorted(
                    [(*s, True) for s in old] + [(*s, False) for s in new])]
                    for old, new in zip(bases, more)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(spans, pa.list_(SPAN))],
                                             names=["doc_id", "spans"])
    return only(docs, doc_id=id_col, text=text_col).mapInArrow(run, SPAN_SCHEMA)


def span_text(spans):
    """``kind:start:end`` of each span, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"], s["stop"])), ",")


def digests(found: DataFrame) -> DataFrame:
    """doc_id, base spans by kind (n_email, ...), base_sha256, spans."""
    base = F.filter("spans", lambda s: s["base"])
    kinds = F.transform(base, lambda s: s["kind"])
    return found.select(
        "doc_id",
        *[(F.size(kinds) - F.size(F.array_remove(kinds, i))).cast("bigint").alias(f"n_{k}")
          for i, k in enumerate(KINDS)],
        F.sha2(span_text(base).cast("binary"), 256).alias("base_sha256"),
        span_text(F.col("spans")).alias("spans"))
