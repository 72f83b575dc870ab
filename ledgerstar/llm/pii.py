"""Personal data: fixed patterns, and a linear-chain conditional random field for what they miss.

The base patterns (email, ip, card, phone) always stand. The field tags white-space separated tokens from
features of the token's word shape and its neighbours' shapes. It is trained once, on the driver, from the
small labelled table in ``pii_labels`` and decoded by Viterbi in numpy batches inside the tasks. A tagged
span counts when it overlaps no base span. Tokens without a digit or an at sign that are not near a token
with one are outside every span, so only the neighbourhoods of such tokens are decoded; all of every text
is scanned for them.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerstar.llm.common import arrow_map, arrow_schema, ident
from ledgerstar.llm.pii_labels import LABELLED

KINDS = ("email", "ip", "card", "phone")
TAGS = ("O", *[f"{p}-{k}" for k in KINDS for p in "BI"])
NEAR = 3   # tokens on either side of a marked token that are decoded with it
BATCH_TOKENS = 16_384   # padded tokens decoded at once
BLOCK = 1_024           # places of a sequence whose scores are held at once

# The base patterns.
_EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

_DIGIT = re.compile("[0-9]")
_MARK = re.compile("[0-9@]")
_TOKEN = re.compile(r"\S+")


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _only_digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the base patterns, by kind, then start; failing matches are dropped."""
    out = []
    if "@" in text:
        out += [("email", m.start(), m.end()) for m in _EMAIL.finditer(text)]
    if not _DIGIT.search(text):
        return out
    if "." in text:
        out += [("ip", m.start(), m.end()) for m in _IP.finditer(text)
                if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m.group().split("."))]
    for m in _CARD.finditer(text):
        digits = _only_digits(m.group()) if m.end() - m.start() >= 13 else ""
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", m.start(), m.end()))
    if "+" in text:
        out += [("phone", m.start(), m.end()) for m in _PHONE.finditer(text) if 9 <= len(_only_digits(m.group())) <= 15]
    return out


# ---- shapes and features ------------------------------------------------------------------------

def shape(token: str) -> str:
    """Word shape: digits d, lower case a, other letters A, the rest as it is; runs folded."""
    out = []
    for c in token:
        s = "d" if "0" <= c <= "9" else "a" if c.islower() else "A" if c.isalpha() else c
        if not out or out[-1] != s:
            out.append(s)
    return "".join(out)[:24]


_HEX = frozenset("0123456789abcdefABCDEF:")


@lru_cache(maxsize=200_000)
def token_features(token: str) -> tuple[str, ...]:
    """Features of a token without its neighbours. Closing marks around it are left off."""
    core = token.strip(".,;:!?\"'<>")
    digits = sum("0" <= c <= "9" for c in core)
    if not digits and "@" not in core:
        return ("plain", f"cue:{_cue(core)}")
    lengths = "-".join(str(len(x)) for x in re.findall(r"[0-9]+", core))[:24]
    mixed = any(c.isalpha() for c in core)
    prefix = _PREFIX.match(core)
    rest = core[prefix.end():] if prefix and _cue(prefix[1]) else core
    return ("s:" + shape(core), "n:" + str(min(digits, 20)), f"l:{lengths}", f"m:{mixed}:{'@' in core}:{core[:1] == '+'}:{'=' in core}",
            f"p:{_cue(prefix[1]) if prefix else None}:{digits >= 7}", "r:" + shape(rest),
            f"at:{core.count('@')}:{core[:1] == '@' or core[-1:] == '@'}", f"v6:{core.count(':') > 1 and all(c in _HEX for c in core)}")


# Words that announce a kind of number, and words that announce another kind of number.
CUE_WORDS = {
    "phone": "call phone phones tel telefon telephone téléphone telefono teléfono tél ring mobile cell fax dial text sms whatsapp handy contact hotline extension callback",
    "card": "card cards carte karte tarjeta kreditkarte visa mastercard amex maestro paid pay charge charged",
    "email": "mail email e-mail mailto address write correo courriel",
    "ip": "host hosts server ip ips login node gateway router ping dns subnet client peer machine rechner address",
    "other": "version release page pages chapter section order room id lot part year isbn issn ref ticket invoice lines line table figure no score serial model build sku volume vol line zip postcode in since from",
}
CUES = {}
for _kind, _words in CUE_WORDS.items():
    for _w in _words.split():
        CUES[_w] = CUES[_w] + "+" + _kind if _w in CUES else _kind
REACH = 3   # tokens before a chain of numbers in which a word may announce it
_NUMBERS = re.compile(r"[0-9().+/\-–]*[0-9][0-9().+/\-–]*")
_PREFIX = re.compile(r"([^\W\d_]+)[:=.](?=.)")


def _cue(token: str) -> str | None:
    return CUES.get(token.strip(".,;:!?\"'<>()").lower())


def chains(tokens: list[str]) -> list[tuple[str, ...]]:
    """Features of each token from the chain of neighbouring tokens of digits and number marks that holds it:
    its digits, whether they pass the check of card numbers, its tokens, the token's place in it, and the nearest
    word before it that announces a number.

    A plus sign, an opening bracket (unless a country code stands before it), 13 digits in one token and a
    closing mark bound a chain. Linear in the number of tokens.
    """
    out: list[tuple[str, ...]] = [()] * len(tokens)
    parts = [_number(t) for t in tokens]
    i = 0
    while i < len(tokens):
        if not parts[i]:
            i += 1
            continue
        end, total = i, 0
        while end < len(tokens) and parts[end]:
            core, own, digits = parts[end]
            if end > i and (own or core[0] == "+" or digits >= 13 or core[0] == "(" and parts[end - 1][0][0] != "+"):
                break
            total += digits
            end += 1
            if tokens[end - 1][-1] in ",;:!?." or digits >= 13:
                break
        core, own, _ = parts[i]
        checked = luhn("".join(_only_digits(parts[j][0]) for j in range(i, end))) if 13 <= total <= 19 else None
        cue = own or next((c for j in range(i - 1, max(-1, i - 1 - REACH), -1) if (c := _cue(tokens[j]))), "none")
        size, n = min(total, 20), min(end - i, 6)
        for j in range(i, end):
            place = "B" if j == i else "I"
            out[j] = (f"c:{size}:{place}", f"ct:{size}:{n}", f"cq:{cue}:{place}", f"cs:{shape(core)}:{place}", f"cl:{size >= 7}:{size >= 13}:{cue}:{place}", f"lu:{checked}:{place}")
        i = end
    return out


@lru_cache(maxsize=200_000)
def _number(token: str) -> tuple[str, str | None, int] | None:
    """(number, kind that a prefix such as ``tel:`` announces, digits) of a token of digits and number marks."""
    core = token.strip(",;:!?\"'<>.")
    prefix = _PREFIX.match(core)
    own = _cue(prefix[1]) if prefix else None
    if own:
        core = core[prefix.end():]
    return (core, own, sum("0" <= c <= "9" for c in core)) if _NUMBERS.fullmatch(core) else None


def _window_features(tokens: list[str], i: int, around: list[tuple[str, ...]]) -> list[str]:
    own = token_features(tokens[i])
    before = token_features(tokens[i - 1]) if i else ("edge",)
    after = token_features(tokens[i + 1]) if i + 1 < len(tokens) else ("edge",)
    return ["bias", *["0" + f for f in own], *["-" + f for f in before[:2]], *["+" + f for f in after[:2]], *around[i]]


# ---- the field ----------------------------------------------------------------------------------

@dataclass
class ChainField:
    """Weights of a linear-chain conditional random field: features x tags, tag x tag, start."""

    index: dict[str, int]
    emit: np.ndarray
    move: np.ndarray
    start: np.ndarray

    def emissions(self, sequences: list[list[str]], around: list[list[tuple[str, ...]]], lo: int, hi: int) -> np.ndarray:
        """(batch, hi - lo, tags) scores of the places ``lo .. hi - 1``, zero beyond a sequence's end."""
        out = np.zeros((len(sequences), hi - lo, len(TAGS)))
        get = self.index.get
        for b, s in enumerate(sequences):
            for i in range(lo, min(hi, len(s))):
                known = [k for f in _window_features(s, i, around[b]) if (k := get(f)) is not None]
                out[b, i - lo] = self.emit[known].sum(0)
        return out

    def decode(self, sequences: list[list[str]]) -> list[list[int]]:
        """Viterbi: the best tag sequence of every token sequence, all sequences of a batch at once.

        Scores are made ``BLOCK`` places at a time; of a whole sequence only the pointers back are kept
        (a byte a tag and token).
        """
        if not sequences:
            return []
        n = np.array([len(s) for s in sequences])
        size, length = len(sequences), int(n.max())
        around = [chains(s) for s in sequences]
        best = np.zeros((size, len(TAGS)))
        back = np.zeros((size, length, len(TAGS)), dtype=np.int8)
        for lo in range(0, length, BLOCK):
            e = self.emissions(sequences, around, lo, min(length, lo + BLOCK))
            for i in range(lo, min(length, lo + BLOCK)):
                if i == 0:
                    best = self.start + e[:, 0]
                    continue
                through = best[:, :, None] + self.move
                back[:, i] = through.argmax(1)
                best = np.where((i < n)[:, None], through.max(1) + e[:, i - lo], best)
        out = []
        for b in range(size):
            tag = int(best[b].argmax())
            path = [tag]
            for i in range(n[b] - 1, 0, -1):
                tag = int(back[b, i, tag])
                path.append(tag)
            out.append(path[::-1])
        return out

    @classmethod
    def train(cls, rows: list[tuple[list[str], list[int]]], steps: int = 250, rate: float = 0.15, ridge: float = 0.02) -> ChainField:
        """Maximum likelihood with an L2 penalty: forward-backward gradients, Adam steps, all rows at once."""
        feats = [[_window_features(t, i, around) for i in range(len(t))] for t, around in ((t, chains(t)) for t, _ in rows)]
        index: dict[str, int] = {}
        for f in (f for s in feats for x in s for f in x):
            index.setdefault(f, len(index))
        size, length, tags = len(rows), max(len(t) for t, _ in rows), len(TAGS)
        x = np.zeros((size, length, len(index)))
        gold = np.zeros((size, length, tags))
        live = np.zeros((size, length))
        for b, (t, y) in enumerate(rows):
            for i in range(len(t)):
                for f in feats[b][i]:
                    x[b, i, index[f]] = 1
                gold[b, i, y[i]] = 1
                live[b, i] = 1
        moves = np.einsum("bis,bit->st", gold[:, :-1], gold[:, 1:])
        w = [np.zeros((len(index), tags)), np.zeros((tags, tags)), np.zeros(tags)]
        m, v = [np.zeros_like(p) for p in w], [np.zeros_like(p) for p in w]

        def lse(a: np.ndarray, axis: int) -> np.ndarray:
            top = a.max(axis, keepdims=True)
            return np.squeeze(top, axis) + np.log(np.exp(a - top).sum(axis))

        for step in range(1, steps + 1):
            e = x @ w[0]
            fwd, bwd = np.zeros_like(e), np.zeros_like(e)
            fwd[:, 0] = e[:, 0] + w[2]
            for i in range(1, length):
                on = live[:, i, None] > 0
                fwd[:, i] = np.where(on, lse(fwd[:, i - 1, :, None] + w[1], 1) + e[:, i], fwd[:, i - 1])
            for i in range(length - 2, -1, -1):
                on = live[:, i + 1, None] > 0
                bwd[:, i] = np.where(on, lse(w[1] + (e[:, i + 1] + bwd[:, i + 1])[:, None, :], 2), 0.0)
            z = lse(fwd[:, -1], 1)
            node = np.exp(fwd + bwd - z[:, None, None]) * live[:, :, None]
            pair = np.exp(fwd[:, :-1, :, None] + w[1] + (e[:, 1:] + bwd[:, 1:])[:, :, None, :] - z[:, None, None, None]) * live[:, 1:, None, None]
            grads = [np.tensordot(x, gold - node, ([0, 1], [0, 1])), moves - pair.sum((0, 1)), (gold[:, 0] - node[:, 0]).sum(0)]
            for p, g, a, s in zip(w, grads, m, v):
                g -= ridge * p
                a += 0.1 * (g - a)
                s += 0.001 * (g * g - s)
                p += rate * (a / (1 - 0.9 ** step)) / (np.sqrt(s / (1 - 0.999 ** step)) + 1e-8)
        return cls(index, *w)


def labelled_rows(table: str = LABELLED) -> list[tuple[list[str], list[int]]]:
    """(tokens, tags) of the labelled table's rows."""
    rows = []
    for line in filter(None, (x.strip() for x in table.splitlines())):
        text, spans, at = "", [], 0
        for m in re.finditer(r"\[(\w+)\|([^\]]+)\]", line):
            text += line[at:m.start()]
            spans.append((m[1], len(text), len(text) + len(m[2])))
            text += m[2]
            at = m.end()
        text += line[at:]
        tokens, tags, before = [], [], None
        for m in _TOKEN.finditer(text):
            span = next((s for s in spans if m.start() < s[2] and m.end() > s[1]), None)
            tokens.append(m.group())
            tags.append(TAGS.index(("I-" if span == before else "B-") + span[0]) if span else 0)
            before = span
        rows.append((tokens, tags))
    return rows


@lru_cache(maxsize=1)
def trained() -> ChainField:
    return ChainField.train(labelled_rows())


# ---- documents ----------------------------------------------------------------------------------

def _neighbourhoods(text: str) -> list[list[tuple[int, int]]]:
    """Runs of tokens around those with a digit or an at sign."""
    if not _MARK.search(text):
        return []
    tokens = [m.span() for m in _TOKEN.finditer(text)]
    marked = [i for i, (a, b) in enumerate(tokens) if _MARK.search(text, a, b)]
    runs: list[list[int]] = []
    for i in marked:
        lo, hi = max(0, i - NEAR), min(len(tokens), i + NEAR + 1)
        if runs and lo <= runs[-1][1]:
            runs[-1][1] = hi
        else:
            runs.append([lo, hi])
    return [tokens[a:b] for a, b in runs]


def _batches(lengths: list[int]) -> Iterator[list[int]]:
    """Numbers of the sequences, shortest first, in batches that hold ``BATCH_TOKENS`` with their padding;
    a longer sequence is a batch of its own."""
    part: list[int] = []
    for i in sorted(range(len(lengths)), key=lengths.__getitem__):
        if part and (len(part) + 1) * lengths[i] > BATCH_TOKENS:
            yield part
            part = []
        part.append(i)
    if part:
        yield part


def tagged_spans(texts: list[str], field: ChainField) -> list[list[tuple[str, int, int]]]:
    """Spans that the field finds in each text. A run is decoded whole, whatever its length."""
    places, sequences = [], []
    for k, t in enumerate(texts):
        for run in _neighbourhoods(t):
            places.append((k, run))
            sequences.append([t[a:b] for a, b in run])
    out: list[list[tuple[str, int, int]]] = [[] for _ in texts]
    for part in _batches([len(s) for s in sequences]):
        for i, path in zip(part, field.decode([sequences[j] for j in part])):
            k, run = places[i]
            open_: tuple[str, int, int] | None = None
            for (a, b), tag in zip([*run, (0, 0)], [*path, 0]):
                name = TAGS[tag]
                if open_ and name == "I-" + open_[0]:
                    open_ = (open_[0], open_[1], b)
                    continue
                if open_:
                    out[k].append(open_)
                open_ = (name[2:], a, b) if name[0] == "B" else None
    return [[x for s in spans if (x := _trimmed(t, s))] for t, spans in zip(texts, out)]


def _trimmed(text: str, span: tuple[str, int, int]) -> tuple[str, int, int] | None:
    """The span without closing marks at its ends and without an announcing prefix (``tel:``); None when no
    digit or at sign is left."""
    kind, a, b = span
    prefix = _PREFIX.match(text, a, b)
    if prefix and _cue(prefix[1]):
        a = prefix.end()
    while a < b and text[a] in ".,;:!?\"'<>":
        a += 1
    while a < b and text[b - 1] in ".,;:!?\"'<>":
        b -= 1
    return (kind, a, b) if _MARK.search(text, a, b) and _holds(kind, text[a:b]) else None


def _holds(kind: str, found: str) -> bool:
    """The checks of the base patterns, for a span of the field: a card has 13 to 19 digits that pass Luhn, a
    phone 7 to 15 digits, the parts of a dotted address are at most 255, an email has an at sign inside."""
    digits = _only_digits(found)
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits)
    if kind == "phone":
        return 7 <= len(digits) <= 15
    if kind == "email":
        return "@" in found[1:-1]
    parts = re.split(r"[:/]", found)[0].split(".") if found.count(".") == 3 else []
    return all(p.isascii() and p.isdigit() and len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in parts) if parts else found.count(":") > 1


def join_spans(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1])))


SPAN = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("base", T.BooleanType())])


def find(df: DataFrame, carry: Column, text_col: str = "text") -> DataFrame:
    """(row, spans): spans (kind, start, end in code points, base) of every text, by kind, then start.

    NULL and empty texts have none. One pass, no shuffle; the trained field (under 1 MB) is sent along.
    """
    src = df.select(carry.alias("row"), F.coalesce(ident(text_col).cast("string"), F.lit("")).alias("t"))
    out = T.StructType([src.schema["row"], T.StructField("spans", T.ArrayType(SPAN))])
    field = df.sparkSession.sparkContext.broadcast(trained())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema(out)
        for b in batches:
            texts = b.column(1).to_pylist()
            rows = []
            for t, extra in zip(texts, tagged_spans(texts, field.value)):
                base = base_spans(t)
                more = [s for s in extra if not any(s[1] < y and x < s[2] for _, x, y in base)]
                both = sorted([(*s, True) for s in base] + [(*s, False) for s in more], key=lambda s: (KINDS.index(s[0]), s[1]))
                rows.append([{"kind": k, "start": a, "end": e, "base": f} for k, a, e, f in both])
            yield pa.RecordBatch.from_arrays([b.column(0).cast(schema.field(0).type), pa.array(rows, schema.field(1).type)], schema=schema)

    return arrow_map(src, run, out)


def summary(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone (base spans), base_sha256, spans, n_added (by the field)."""
    found = find(df, ident(id_col), text_col)
    base = F.filter("spans", lambda s: s["base"])

    def text(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(F.col("row").alias(id_col), *[count(k) for k in KINDS], F.sha2(text(base), 256).alias("base_sha256"), text(F.col("spans")).alias("spans"),
                        F.size(F.filter("spans", lambda s: ~s["base"])).cast("long").alias("n_added"))


def redact(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with every span replaced by its kind in angle brackets; overlapping spans are one."""
    out, at = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= at:
            out += [text[at:a], f"<{kind}>"]
        at = max(at, b)
    return "".join([*out, text[at:]])
