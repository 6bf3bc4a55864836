"""Personal data in texts: exact base detectors, and a semi-Markov conditional random field that adds spans.

The field runs over the digit groups of a numeric region and over the labels of a written-out e-mail address. A segment of
up to ``max_groups`` groups (an address: of all its labels) is scored as a whole: its digits, grouping, separators, check
digit, octets, marks, neighbours, the word before it, and the kind of segment it follows. Dynamic programming over groups
and kinds picks boundaries and types together; everything outside such regions is no entity in any labelling, so leaving it
out changes no result. The weights are fitted by regularised maximum likelihood on labelled lines that ``training_lines``
and ``address_lines`` write from a seed; no corpus row is used.

Base spans always stay; a span of the field that overlaps one is left out. All scans are linear in the text.
"""

from __future__ import annotations

import math
import random
import re
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadastra.llm.common import table

KINDS = ("email", "ip", "card", "phone")
#: Digit groups of one number at most: a number written in more groups is not added (base detectors have no such bound).
MAX_GROUPS = 6

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
# A number's run can only match from its first digit: from a later one it would end at the same place.
IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

REGION = re.compile(r"(?<!\w)[+(]{0,2}[0-9]+(?:[ ().-]{1,3}[0-9]+)*+")
GROUP = re.compile(r"[0-9]+")
_AT, _DOT = r"(?:\(at\)|\[at\])", r"(?: ?(?:\(dot\)|\[dot\]) ?|\. ?)"
SPELLED = re.compile(rf"(?<![\w.%+-])([A-Za-z0-9._%+-]++ ?{_AT} ?[A-Za-z0-9-]++)((?:{_DOT}[A-Za-z0-9-]++)+)", re.I)
MARK = re.compile(_AT, re.I)
LABEL = re.compile(rf"({_DOT})([A-Za-z0-9-]++)", re.I)
CUES = {
    "phone": ("tel", "phone", "call", "mobile", "fax", "telefon", "móvil", "portable", "whatsapp"),
    "card": ("card", "visa", "mastercard", "amex", "karte", "carte", "tarjeta"),
    "ip": ("ip", "host", "server", "address", "adresse"),
    "email": ("mail", "email", "write", "contact", "contacto", "courriel", "correo", "kontakt", "schreiben"),
}
CUE = {w: k for k, ws in CUES.items() for w in ws}


def luhn(digits: str) -> bool:
    double = sum((0, 2, 4, 6, 8, 1, 3, 5, 7, 9)[int(d)] for d in digits[-2::-2])
    return (double + sum(map(int, digits[-1::-2]))) % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    at, floor = text.find("@"), 0
    while at >= 0:
        start = at
        while start > floor and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            floor = m.end()
        else:
            floor = max(floor, start)
        at = text.find("@", max(at + 1, floor))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by kind as listed and start."""
    out = [("email", a, b) for a, b in emails(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(len(p.lstrip("0")) < 4 and int(p) <= 255 for p in m.groups())]
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 13 and 13 <= len(d := m[0].replace(" ", "").replace("-", "")) <= 19 and luhn(d):
            out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= sum(c.isdigit() for c in m[0]) <= 15]
    return out


Segment = tuple[int, int, str, tuple[str, ...], int, int]


def _cue(text: str, at: int) -> str:
    """The kind that the word before a place speaks for."""
    word = re.findall(r"[^\W\d]+", text[max(0, at - 24) : at].lower())
    return CUE.get(word[-1], "") if word else ""


def _address_segments(text: str, m: re.Match) -> tuple[int, list[Segment]]:
    """Groups of a written-out address (its beginning with the first label, then each label), and its segments."""
    labels = list(LABEL.finditer(text, m.end(1), m.end()))
    cue, head, out, styles = _cue(text, m.start()), m[1].lower(), [], []
    for j, label in enumerate(labels, 1):
        dot = label[1].lower()
        styles.append("word" if "dot" in dot else "loose" if " " in dot else "tight")
        last, after = label[2], text[label.end() : label.end() + 1]
        tail = f"{'letters' if last.isalpha() else 'other'}{min(len(last), 8)}"
        case = "upper" if last[:1].isupper() and "word" not in styles else "same"
        f = (f"at={'round' if '(at)' in head else 'square'}", f"dots={'+'.join(sorted(set(styles)))}", f"tail={tail}", f"case={case}", f"cue={cue}", f"labels={min(j, 4)}", f"more={j < len(labels)}", f"glued={after.isalnum()}")
        out.append((0, j + 1, "email", tuple(f"email:{x}" for x in f), m.start(), label.end()))
    return len(labels) + 1, out


def _segments(text: str, groups: list[tuple[int, int]], floor: int, max_groups: int = MAX_GROUPS) -> list[Segment]:
    """(first, past, kind, features, start, end) of all segments of a region that could be an entity."""
    out = []
    cue = _cue(text, floor)
    for i in range(len(groups)):
        for j in range(i + 1, min(len(groups), i + max_groups) + 1):
            a, b = groups[i][0], groups[j - 1][1]
            while a > floor and text[a - 1] in "+(":
                a -= 1
            body = text[a:b]
            digits = "".join(text[s:e] for s, e in groups[i:j])
            n = len(digits)
            if n > 19:
                break
            seps = "".join(sorted({c for c in body if not c.isdigit()}))
            lens = "-".join(str(e - s) for s, e in groups[i:j])
            glued = (a > 0 and (text[a - 1].isalnum() or text[a - 1] in "_/=#-.")) or (
                b < len(text) and (text[b].isalnum() or text[b] in "_/=" or (text[b] in "-." and text[b + 1 : b + 2].isalnum()))
            )
            cut = (i > 0) + (j < len(groups))
            shared = (f"cue={cue if i == 0 else ''}", f"glued={glued}", f"cut={cut}", f"seps={seps}")
            if 7 <= n <= 15:
                plus = body[0] == "+"
                f = (f"n={n}", f"lens={lens}", f"plus={plus}", f"paren={'(' in body and ')' in body}", f"one={i + 1 == j}", f"plus,one={plus},{i + 1 == j}")
                out.append((i, j, "phone", tuple(f"phone:{x}" for x in f + shared), a, b))
            if 13 <= n:
                f = (f"luhn={luhn(digits)}", f"n={n}", f"groups={j - i}")
                out.append((i, j, "card", tuple(f"card:{x}" for x in f + shared), groups[i][0], b))
            if j - i == 4 and set(seps) <= {"."} and n <= 12:
                octets = all(int(text[s:e]) <= 255 for s, e in groups[i:j])
                lead = any(text[s] == "0" and e - s > 1 for s, e in groups[i:j])
                out.append((i, j, "ip", tuple(f"ip:{x}" for x in (f"octets={octets}", f"lead={lead}", *shared)), groups[i][0], b))
    return out


def regions(text: str, max_groups: int = MAX_GROUPS) -> Iterator[tuple[int, list[Segment]]]:
    """(number of groups, segments) of every region of a text that could hold an entity."""
    for m in REGION.finditer(text):
        if sum(c.isdigit() for c in m[0]) >= 4:
            groups = [g.span() for g in GROUP.finditer(text, *m.span())]
            if segs := _segments(text, groups, m.start(), max_groups):
                yield len(groups), segs
    if MARK.search(text):
        for m in SPELLED.finditer(text):
            yield _address_segments(text, m)


Arc = tuple[int, float, str, Segment | None]


def _lattice(n: int, segs: list[Segment], weight: dict[str, float]) -> list[list[Arc]]:
    """For each end, the segments that reach it: (first, score, label, segment); a lone group outside any entity scores 0."""
    into: list[list[Arc]] = [[] for _ in range(n + 1)]
    for j in range(1, n + 1):
        into[j].append((j - 1, 0.0, "O", None))
    for s in segs:
        into[s[1]].append((s[0], sum(weight.get(f, 0.0) for f in s[3]), s[2], s))
    return into


def _step(weight: dict[str, float], before: str, label: str) -> float:
    return weight.get(f"{before}>{label}", 0.0)


def decode(text: str, weight: dict[str, float], max_groups: int = MAX_GROUPS) -> list[tuple[str, int, int]]:
    """The most likely entities of a text under the field."""
    found = []
    for n, segs in regions(text, max_groups):
        into = _lattice(n, segs, weight)
        best: list[dict[str, tuple]] = [{"": (0.0, None, 0, "")}]
        for j in range(1, n + 1):
            at: dict[str, tuple] = {}
            for i, s, label, seg in into[j]:
                for before, x in best[i].items():
                    score = x[0] + s + _step(weight, before, label)
                    if label not in at or score > at[label][0]:
                        at[label] = (score, seg, i, before)
            best.append(at)
        j, label = n, max(best[n], key=lambda k: best[n][k][0])
        while j:
            _, seg, i, before = best[j][label]
            if seg is not None:
                found.append((seg[2], seg[4], seg[5]))
            j, label = i, before
    return found


def address_lines(seed: int = 13, n: int = 300) -> list[tuple[str, list[tuple[str, int, int]]]]:
    """Labelled lines with written-out e-mail addresses, and with the same marks in other use."""
    r = random.Random(seed)
    names = "joe anna m.weber info sales jean-luc k_lopez office team42 press".split()
    hosts = "example mail firma sample-shop uni posteo web intern acme".split()
    words = "the order of was sent on page about from items total and section you can reach us".split()
    prose = "noon home Then once school work price least That night this".split()
    out = []
    for _ in range(n):
        lead = " ".join(r.choice(words) for _ in range(r.randrange(1, 5)))
        lead += " " + r.choice(CUES["email"]) + r.choice(["", ":"]) if r.random() < 0.3 else ""
        at, space = r.choice(["(at)", "[at]", "(AT)"]), r.choice(["", " "])
        if r.random() < 0.55:
            dot = r.choice([f"{space}{at[0]}dot{at[-1]}{space}", f" {at[0]}dot{at[-1]} ", "."])
            labels = [r.choice(hosts)] + ([r.choice(hosts)] if r.random() < 0.2 else []) + [r.choice("com org net de fr es io co.uk".split()).replace(".", dot)]
            x = f"{r.choice(names)}{space}{at}{space}{dot.join(labels)}"
            spans, tail = [("email", len(lead) + 1, len(lead) + 1 + len(x))], r.choice(["", ".", ",", " " + r.choice(words), ". " + r.choice(prose).title() + " it was"])
        else:
            x = f"{r.choice(words)} {at} {r.choice(prose)}" + r.choice([f". {r.choice(prose).title()} {r.choice(words)}", f" {r.choice(words)}", f" {r.randrange(9)}.{r.randrange(10, 60)}", f" {r.randrange(9)}.50. {r.choice(prose).title()}", f".{r.choice(prose)}"])
            spans, tail = [], r.choice(["", "."])
        out.append((f"{lead} {x}{tail} {r.choice(words)}", spans))
    return out


def training_lines(seed: int = 11, n: int = 900) -> list[tuple[str, list[tuple[str, int, int]]]]:
    """Labelled lines: phone, card and network numbers in many written forms, among other numbers that are none."""
    r = random.Random(seed)
    d = lambda k: "".join(r.choice("0123456789") for _ in range(k))
    lead = lambda: r.choice("23456789")

    def card() -> str:
        x = r.choice(["4", "51", "37", "6011"])
        x += d(15 - len(x))
        x += next(c for c in "0123456789" if luhn(x + c))
        return r.choice([x, " ".join(x[i : i + 4] for i in range(0, 16, 4)), "-".join(x[i : i + 4] for i in range(0, 16, 4))])

    def phone() -> str:
        a, b, c = lead() + d(2), lead() + d(2), d(4)
        return r.choice([f"+1 ({a}) {b}-{c}", f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"+{r.choice(['49', '33', '34', '44'])} {lead()}{d(2)} {d(3)} {d(4)}", f"+1{a}{b}{c}", f"({a}) {b} {c}"])

    def none() -> str:
        return r.choice([
            str(r.randrange(1900, 2030)), d(r.randrange(1, 7)), f"{r.randrange(1990, 2030)}-{r.randrange(1, 13):02}-{r.randrange(1, 29):02}",
            f"{r.randrange(1, 10)}.{r.randrange(20)}.{r.randrange(20)}", f"{d(2)}.{d(2)}.20{d(2)}", d(r.randrange(7, 12)), d(16) if r.random() < 0.5 else d(13),
            f"{d(1)}.{d(3)} {d(2)}", f"{r.randrange(256, 999)}.{d(3)}.{d(3)}.{d(2)}", f"{d(3)} {d(3)} {d(3)}", f"{d(2)}-{d(5)}-{d(4)}", f"{d(4)} {d(4)}", f"({d(4)})", f"{d(3)}.{d(2)}",
        ])

    words = "the order of was sent on page about number from items total and section year".split()
    out = []
    for _ in range(n):
        text, spans = " ".join(r.choice(words) for _ in range(r.randrange(1, 5))), []
        for _ in range(r.randrange(1, 4)):
            kind = r.choice(["phone", "card", "ip", None, None, None])
            if kind and r.random() < 0.25:
                text += " " + r.choice(CUES[kind]) + r.choice(["", ":"])
            text += " "
            x = {"phone": phone, "card": card, "ip": lambda: ".".join(str(r.randrange(256)) for _ in range(4)), None: none}[kind]()
            if kind:
                spans.append((kind, len(text), len(text) + len(x)))
            text += x + r.choice(["", ".", ",", " " + r.choice(words), "%%%"])
            text += " " + r.choice(words) if r.random() < 0.9 else ""
        out.append((text, spans))
    return out


def _log_sum(xs: list[float]) -> float:
    m = max(xs)
    return m + math.log(sum(math.exp(x - m) for x in xs))


def _path(n: int, gold: list[Segment]) -> Iterator[tuple[str, str, Segment | None]]:
    """(label before, label, segment) along the labelled segmentation."""
    starts, j, before = {s[0]: s for s in gold}, 0, ""
    while j < n:
        seg = starts.get(j)
        label = seg[2] if seg else "O"
        yield before, label, seg
        j, before = (seg[1] if seg else j + 1), label


@lru_cache(maxsize=2)
def train(seed: int = 11, n: int = 900, epochs: int = 12, rate: float = 0.3, decay: float = 1e-4) -> dict[str, float]:
    """Weights that maximise the likelihood of the labelled lines' segmentations, by AdaGrad with forward-backward."""
    data = []
    for text, spans in training_lines(seed, n) + address_lines(seed + 2, n // 3):
        gold = set(spans)
        data += [(k, segs, [s for s in segs if (s[2], s[4], s[5]) in gold]) for k, segs in regions(text)]
    weight: dict[str, float] = {}
    power: dict[str, float] = {}
    order = random.Random(seed)
    for _ in range(epochs):
        order.shuffle(data)
        for k, segs, gold in data:
            into = _lattice(k, segs, weight)
            a: list[dict[str, float]] = [{"": 0.0}]
            for j in range(1, k + 1):
                terms: dict[str, list[float]] = {}
                for i, s, label, _ in into[j]:
                    terms.setdefault(label, []).extend(x + s + _step(weight, before, label) for before, x in a[i].items())
                a.append({label: _log_sum(xs) for label, xs in terms.items()})
            b: list[dict[str, list[float]]] = [{} for _ in range(k)] + [{label: [0.0] for label in a[k]}]
            done: list[dict[str, float]] = [{}] * (k + 1)
            all_paths = _log_sum(list(a[k].values()))
            step: dict[str, float] = {}
            for before, label, seg in _path(k, gold):
                for f in (f"{before}>{label}", *(seg[3] if seg else ())):
                    step[f] = step.get(f, 0.0) + 1
            for j in range(k, 0, -1):
                done[j] = {label: _log_sum(xs) for label, xs in b[j].items()}
                for i, s, label, seg in into[j]:
                    for before, x in a[i].items():
                        arc = s + _step(weight, before, label) + done[j][label]
                        b[i].setdefault(before, []).append(arc)
                        p = math.exp(x + arc - all_paths)
                        for f in (f"{before}>{label}", *(seg[3] if seg else ())):
                            step[f] = step.get(f, 0.0) - p
            for f, g in step.items():
                g -= decay * weight.get(f, 0.0)
                power[f] = power.get(f, 1e-8) + g * g
                weight[f] = weight.get(f, 0.0) + rate * g / math.sqrt(power[f])
    return weight


def _ordered(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1], s[2])))


def all_spans(text: str, weight: dict[str, float], max_groups: int = MAX_GROUPS) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """(base, base and added spans) of a text; of added spans that overlap, the first in the text stays."""
    base = base_spans(text)
    ordered = sorted(base, key=lambda s: s[1])
    starts, reach = [s[1] for s in ordered], list(accumulate((s[2] for s in ordered), max, initial=0))
    added, floor = [], 0
    for k, a, b in sorted(decode(text, weight, max_groups), key=lambda s: s[1]):
        if a >= floor and reach[bisect_left(starts, b)] <= a:
            added.append((k, a, b))
            floor = b
    return base, base + added


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", weight: dict[str, float] | None = None, max_groups: int = MAX_GROUPS) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base, spans): counts of base spans; base and spans list kind:start:end.

    One row per input row; null texts count as empty and give zeros and empty lists. Offsets are code points, the end
    exclusive. Repeated rows are scanned each. An empty table gives an empty result; other columns are ignored.
    """
    weight = train() if weight is None else weight

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for t in b.column(1):
                base, spans = all_spans(t.as_py() or "", weight, max_groups)
                n = [sum(k == kind for k, _, _ in base) for kind in KINDS]
                rows.append((*n, _ordered(base), _ordered(spans)))
            cols = list(zip(*rows, strict=True)) or [()] * 6
            kinds = [pa.int64()] * 4 + [pa.string()] * 2
            names = ["doc_id", *(f"n_{k}" for k in KINDS), "base", "spans"]
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, t) for c, t in zip(cols, kinds, strict=True))], names=names)

    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("t"))
    return narrow.mapInArrow(run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base string, spans string")


def masked(text: str, spans: str) -> str:
    """The text with each span replaced by its kind in angle brackets; of overlapping spans the first stands for all."""
    out, at = [], 0
    for k, a, b in sorted(((s.split(":")[0], *map(int, s.split(":")[1:])) for s in spans.split(",") if s), key=lambda s: s[1]):
        if a >= at:
            out += [text[at:a], f"<{k}>"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def op6_pii_semi_markov(spark, sf_dir: str) -> DataFrame:
    found = find_pii(table(spark, sf_dir, "documents"))
    return found.withColumn("base_sha256", F.sha2("base", 256)).select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"
    )


