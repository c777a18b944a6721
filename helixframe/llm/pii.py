"""Personal data: base patterns plus a linear-chain CRF over word shapes.

The base patterns find e-mail addresses, IPv4 addresses, payment cards (Luhn) and international
phone numbers. The CRF adds what the patterns miss: access tokens, social security numbers, IPv6
addresses, and phone or card numbers in national or split notation. Its weights come from a small labelled
table, with values by a seeded generator; decoding is Viterbi over numpy batches. A span of the chain
counts if its kind's own check holds: Luhn, a valid address, a plausible number of digits, a token's length.

Only pieces with a digit or an at-sign, or punctuation beside one, may carry an entity label; every
other word is O by construction, so an all-letter token is not found. Splitting a text at such words and
decoding the islands between them therefore gives the same path as decoding the whole text. All steps take
time in proportion to the text, whatever its characters.

Defined results: null text counts as empty and gives no spans; an empty table gives an empty table;
repeated rows give one row each; null doc_id stays null; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import ipaddress
import re
from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from helixframe.llm.common import documents, small_batches

# Kinds of the base patterns in their order, then the kinds that only the CRF finds.
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "secret", "ssn")

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_HINT = re.compile(r"[0-9@]")
_DIGIT = re.compile(r"[0-9]")
_SPACE = re.compile(r"[\x20\x09-\x0D]")

Span = tuple[int, int, int]  # start, kind, end


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches: the local part can't hold '@', so it is the run of its characters before one."""
    floor, at = 0, text.find("@")
    while at >= 0:
        start = at
        if domain := _DOMAIN.match(text, at):
            while start > floor and text[start - 1] in _LOCAL:
                start -= 1
            if start < at:
                yield start, domain.end()
                floor = at = domain.end()
                at = text.find("@", at)
                continue
        at = text.find("@", at + 1)


def _addresses(text: str) -> Iterator[tuple[int, int]]:
    """Four parts at a time of each run of dotted numbers: a match of the pattern starts and ends where a number does."""
    for m in _DOTTED.finditer(text):
        parts = m[0].split(".")
        at = m.start()
        for k in range(0, len(parts) - 3, 4):
            end = at + sum(map(len, parts[k : k + 4])) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in parts[k : k + 4]):
                yield at, end
            at = end + 1


def base_spans(text: str) -> list[Span]:
    """Spans of the base patterns by start, then kind."""
    if not _HINT.search(text):
        return []
    found = [(a, 0, b) for a, b in _emails(text)]
    if "." in text:
        found += [(a, 1, b) for a, b in _addresses(text)]
    for m in _CARD.finditer(text):
        digits = "".join(_DIGIT.findall(m[0]))
        if 14 <= len(digits) <= 19 and _luhn(digits):
            found.append((m.start(), 2, m.end()))
    if "+" in text:
        found += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text) if 10 <= sum(c.isdigit() for c in m[0]) <= 15]
    return sorted(found)


# --- the chain: pieces, features, labels -------------------------------------------------------

# an IPv6 address or a time, a run of word characters, or one other character
_RUN = re.compile(r"[0-9A-Fa-f]{0,4}(?::[0-9A-Fa-f]{0,4}){2,8}(?![0-9A-Za-z:])|[A-Za-z0-9_@.%+-]+|[^\s]")
_JOINS = frozenset("()+-./#")
LABELS = ("O", *(f"{x}-{k}" for k in KINDS for x in "BI"))
_LABEL = {x: i for i, x in enumerate(LABELS)}
#: Pieces of context that are looked at before and behind an island, and characters that they are sought in.
CONTEXT, AHEAD, CONTEXT_CHARS = 5, 2, 48
#: Features look at so many characters of a piece.
SEEN = 64


def places(text: str, start: int, end: int) -> list[tuple[int, int]]:
    """Pieces of a stretch of a text. Dots and the like at a run's ends are pieces of their own."""
    out = []
    for m in _RUN.finditer(text, start, end):
        a, b = m.span()
        if m[0][0] in ":" or ":" in m[0]:
            out.append((a, b))
            continue
        right = a + len(m[0].rstrip(".%+-"))
        left = min(right, a + len(m[0]) - len(m[0].lstrip(".-")))
        out += [(i, i + 1) for i in range(a, left)]
        if left < right:
            out.append((left, right))
        out += [(i, i + 1) for i in range(max(left, right), b)]
    return out


def _band(n: int) -> str:
    return str(n) if n < 5 else "5-9" if n < 10 else "10-15" if n < 16 else "16-19" if n < 20 else "20-29" if n < 30 else "30-41" if n < 42 else "42+"


def shape(piece: str) -> str:
    """Word shape: classes of characters with the lengths of their runs, long runs in bands."""
    out, last, run = [], "", 0
    for c in f"{piece[:SEEN]}\0":
        k = "d" if c.isdigit() else "X" if c.isupper() else "x" if c.isalpha() else c
        if k == last:
            run += 1
            continue
        if last:
            out.append(f"{last}{_band(run)}")
        last, run = k, 1
    return "".join(out) if len(out) <= 7 else "mixed"


# Words that announce or rule out an entity, as one feature each.
CUES = {
    "secret": ("secret", "token", "key", "apikey", "api_key", "password", "passwd", "bearer", "auth", "authorization", "credential", "credentials", "jwt", "access", "private"),
    "digest": ("md5", "sha", "sha1", "sha256", "checksum", "hash", "digest", "commit", "revision", "etag", "uuid", "guid", "session", "trace", "blob", "object", "build"),
    "phone": ("phone", "tel", "telephone", "call", "mobile", "cell", "fax", "dial", "telefon", "appeler", "ring", "hotline"),
    "card": ("card", "visa", "mastercard", "amex", "credit", "debit", "pay", "paid", "charged"),
    "ssn": ("ssn", "social", "security", "taxpayer"),
    "number": ("isbn", "issn", "order", "invoice", "item", "part", "version", "page", "chapter", "section", "figure", "table", "serial", "tracking", "id", "no", "nr", "ref", "doi", "account"),
    "address": ("ip", "host", "server", "address", "ipv6", "gateway", "addr", "ping", "dns"),
}
_CUE = {w: k for k, ws in CUES.items() for w in ws}


@lru_cache(maxsize=1 << 14)
def _traits(piece: str, size: int) -> tuple[str, str, tuple[str, ...], frozenset[str]]:
    """Of the start of a piece and its length: its shape, how it looks as a neighbour, its own features, and the cues in it."""
    digits = sum(c.isdigit() for c in piece)
    classes = [c.isdigit() + 2 * c.isupper() + 4 * c.islower() for c in piece]
    turns = sum(a != b for a, b in zip(classes, classes[1:], strict=False))
    kind = "time" if re.fullmatch("[0-9]{1,2}(:[0-9]{2}){1,2}", piece) else "six" if ":" in piece[1:] else "hex" if re.fullmatch("[0-9a-f]+|[0-9A-F]+", piece) else "word" if piece.isalnum() else "uuid" if re.fullmatch("[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}", piece) else "other"
    band, own = _band(size), shape(piece)
    luhn = 13 <= digits <= 19 and digits == size and _luhn(piece)
    first = piece[:1] if not piece[:1].isalnum() or piece[0] == "0" else "w"
    cues = frozenset(_CUE[w] for w in re.split("[^a-z0-9]+|(?<=api)_", piece.lower()) if w in _CUE)
    return own, own if _HINT.search(piece) or not piece.isalpha() else "w", ("bias", f"shape={own}", f"digits={_band(digits)}", f"size={band}", f"kind={kind}|{band}", f"turns={min(turns, 12) // 3}|{band}", f"first={first}", f"luhn={luhn}"), cues


_END = ("", "end", (), frozenset())


def _features(pieces: list[str], i: int) -> list[str]:
    """As many for each piece."""
    at = lambda j: _traits(pieces[j][:SEEN], len(pieces[j])) if 0 <= j < len(pieces) else _END
    own, _, alone, _ = at(i)
    one, two, after, later = at(i - 1)[1], at(i - 2)[1], at(i + 1)[1], at(i + 2)[1]
    cues = frozenset().union(*(at(j)[3] for j in range(i - CONTEXT, i)))
    cue = "+".join(sorted(cues)) or "none"
    return [
        *alone, f"cue={cue}", f"cue={cue}|{alone[4]}", f"cue={cue}|{own}", f"before={one}", f"after={after}", f"pair={one}|{own}", f"next={own}|{after}", f"three={two}|{one}|{own}", f"ahead={own}|{after}|{later}",
    ]


def _may_hold(piece: str) -> bool:
    return piece in _JOINS or ":" in piece[1:] or bool(_HINT.search(piece))


@dataclass
class Island:
    """Neighbouring pieces that may hold an entity, with a little context on either side."""

    pieces: list[str]
    places: list[tuple[int, int]]
    first: int
    last: int  # exclusive


def islands(text: str) -> list[Island]:
    out, floor = [], 0
    while hint := _HINT.search(text, floor):
        start = hint.start()
        while start > floor and not text[start - 1].isspace():
            start -= 1
        end = hint.start()
        while True:  # on over white-space words with a digit, an at-sign, or joins only
            stop = _SPACE.search(text, end)
            end = stop.start() if stop else len(text)
            after = end
            while after < len(text) and text[after] == " ":
                after += 1
            stop = _SPACE.search(text, after)
            word = text[after : stop.start() if stop else len(text)]
            if after - end == 1 and word and (_HINT.search(word) or set(word) <= _JOINS):
                end = after
                continue
            break
        near = places(text, max(0, start - CONTEXT_CHARS), start)[-CONTEXT:]
        own = places(text, start, end)
        spots = near + own + places(text, end, min(len(text), end + CONTEXT_CHARS // 2))[:AHEAD]
        pieces = [text[a:b] for a, b in spots]
        first = len(near)
        for i in range(len(near), len(near) + len(own) + 1):  # what can't hold an entity parts islands
            if i == len(near) + len(own) or not _may_hold(pieces[i]):
                if first < i:
                    left, right = max(0, first - CONTEXT), i + AHEAD
                    out.append(Island(pieces[left:right], spots[left:right], first - left, i - left))
                first = i + 1
        floor = max(end, hint.end())
    return out


@dataclass
class Crf:
    """Weights: emission[feature, label], transition[label, label], start[label]."""

    features: dict[str, int]
    emission: np.ndarray
    transition: np.ndarray

    def scores(self, island: Island) -> np.ndarray:
        """Emission scores of an island's own pieces."""
        known = [[self.features[f] for f in _features(island.pieces, i) if f in self.features] for i in range(island.first, island.last)]
        return np.array([self.emission[k].sum(axis=0) for k in known])

    def decode(self, batch: list[Island]) -> list[np.ndarray]:
        """Viterbi, all islands of one length at a time."""
        by_length: dict[int, list[int]] = defaultdict(list)
        for k, x in enumerate(batch):
            by_length[x.last - x.first].append(k)
        paths: list[np.ndarray] = [np.zeros(0, int)] * len(batch)
        for length, members in by_length.items():
            step = max(1, 100_000 // max(1, length))
            for at in range(0, len(members), step):
                part = members[at : at + step]
                score = np.stack([self.scores(batch[k]) for k in part])
                best, back = score[:, 0] + self.transition[0], np.zeros((length, len(part), len(LABELS)), np.int8)
                for t in range(1, length):
                    through = best[:, :, None] + self.transition[None]
                    back[t] = through.argmax(axis=1)
                    best = through.max(axis=1) + score[:, t]
                path = np.zeros((len(part), length), np.int8)
                path[:, -1] = best.argmax(axis=1)
                for t in range(length - 1, 0, -1):
                    path[:, t - 1] = back[t, np.arange(len(part)), path[:, t]]
                for k, p in zip(part, path, strict=True):
                    paths[k] = p
        return paths


def _allowed() -> np.ndarray:
    """I-k follows B-k or I-k only; the text before an island counts as O."""
    ok = np.ones((len(LABELS), len(LABELS)), bool)
    for i, x in enumerate(LABELS):
        if x[0] == "I":
            ok[:, i] = [y[1:] == x[1:] for y in LABELS]
    return ok


def _gold(x: Island, spans: list[tuple[int, int, str]]) -> list[int]:
    out: list[int] = []
    last = None
    for a, b in x.places[x.first : x.last]:
        hit = next((s for s in spans if s[0] <= a and b <= s[1]), None)
        out.append(0 if hit is None else _LABEL[f"{'I' if hit is last else 'B'}-{hit[2]}"])
        last = hit
    return out


def _log_sum(a: np.ndarray, axis: int) -> np.ndarray:
    most = a.max(axis=axis, keepdims=True)
    return np.log(np.exp(a - most).sum(axis=axis)) + most.squeeze(axis)


def train(table: Iterable[tuple[str, list[tuple[int, int, str]]]], rounds: int = 120, rate: float = 0.3, decay: float = 0.05) -> Crf:
    """Maximum likelihood with L2 by AdaGrad; expectations come from forward-backward in log space, all islands of one length at a time.

    table: texts with (start, end, kind) spans. It is meant to be small and stays on the driver.
    """
    data = [(x, _gold(x, spans)) for text, spans in table for x in islands(text)]
    names = [[_features(x.pieces, i) for i in range(x.first, x.last)] for x, _ in data]
    index = {f: i for i, f in enumerate(sorted({f for rows in names for row in rows for f in row}))}
    use = np.array([[index[f] for f in row] for rows in names for row in rows])
    gold = np.eye(len(LABELS))[[g for _, own in data for g in own]]
    sizes = np.array([len(own) for _, own in data])
    first = np.cumsum(sizes) - sizes
    groups = [first[sizes == n][:, None] + np.arange(n) for n in np.unique(sizes)]
    wanted = np.zeros((len(LABELS), len(LABELS)))
    for _, own in data:
        np.add.at(wanted, ([0, *own[:-1]], own), 1)
    mask = np.where(_allowed(), 0.0, -1e9)
    model = Crf(index, np.zeros((len(index), len(LABELS))), np.zeros((len(LABELS), len(LABELS))))
    seen = [np.full_like(model.emission, 1e-8), np.full_like(model.transition, 1e-8)]
    for _ in range(rounds):
        move = model.transition + mask
        score = model.emission[use].sum(axis=1)
        left, pairs = gold.copy(), np.zeros_like(move)
        for at in groups:
            own = score[at]
            ahead, behind = np.zeros_like(own), np.zeros_like(own)
            ahead[:, 0] = own[:, 0] + move[0]
            for t in range(1, at.shape[1]):
                ahead[:, t] = _log_sum(ahead[:, t - 1, :, None] + move, 1) + own[:, t]
            for t in range(at.shape[1] - 2, -1, -1):
                behind[:, t] = _log_sum(move + (own[:, t + 1] + behind[:, t + 1])[:, None], 2)
            z = _log_sum(ahead[:, -1], 1)
            prob = np.exp(ahead + behind - z[:, None, None])
            left[at] -= prob
            pairs[0] += prob[:, 0].sum(axis=0)
            for t in range(1, at.shape[1]):
                pairs += np.exp(ahead[:, t - 1, :, None] + move + (own[:, t] + behind[:, t])[:, None] - z[:, None, None]).sum(axis=0)
        each = np.column_stack([np.bincount(use.ravel(), np.repeat(left[:, k], use.shape[1]), len(index)) for k in range(len(LABELS))])
        grad = [each - decay * model.emission, wanted - pairs - decay * model.transition]
        for w, g, s in zip((model.emission, model.transition), grad, seen, strict=True):
            s += g * g
            w += rate * g / np.sqrt(s)
    model.transition = model.transition + mask
    return model


#: Patterns of lines; {w} is filler, and kinds that aren't in KINDS are not personal.
LINES = (
    "{secret:key}", "{secret:jwt} {w}", "{secret:upper}", "{ip:six}", "{phone:zero}", "{phone:dash}", "{ssn}", "{card:split}", "{uuid}", "{digest}", "{digest:32}", "{isbn}", "{version}", "{number}", "{date}", "{time}",
    "{w} token = \"{secret}\" {w}", "api_key: {secret:key} {w}", "{w} secret {secret:key}, {w}", "Authorization: Bearer {secret:jwt} {w}", "export TOKEN={secret:key}", "password: {secret:mixed} {w}", "{w} the access token {secret:mixed}. {w}", "key '{secret}'### {w}", "{w} auth {secret:jwt}; {w}", "{w} my key is {secret:upper} {w}", "{w} = \"{secret:key}\" {w}", "{w} {secret:upper} {w}", "credentials {secret:upper}: {secret:mixed} {w}", "{w} {secret:jwt} {w}", "{w} {secret:key} {w}", "{w} secret: {secret} {w}",
    "call {phone} {w}", "{w} {phone} {w}", "tel. {phone:plain} {w}", "{w} call {phone:local} {w}", "{w} ({w}) {phone:dash}, {w}", "phone: {phone:dash} {w}", "{w} {phone:local} {w}", "fax {phone:dots} {w}", "{w} telefon {phone:zero} {w}", "mobile {phone:zero}. {w}", "{w} {phone:dots} {w}", "{w} {phone:dash} {w}", "ring {phone:local}! {w}", "{w} {phone:zero} {w}",
    "{w} {card} {w}", "card {card:split} {w}", "pay {card}, {w}", "{w} {card:split}. {w}", "{w} visa {card:dash} {w}", "{w} {card:dash} {w}", "{w} {card}$$$ {w}", "que {card} {card} {w}",
    "ssn {ssn} {w}", "{w} social security number {ssn}, {w}", "{w} {ssn} {w}", "SSN: {ssn}. {w}",
    "from {ip} {w}", "{w} host {ip:six} {w}", "ping {ip:six}, {w}", "{w} {ip:six} {w}", "{w} address {ip:six}. {w}", "{w} {ip}!! {w}",
    "write {email} {w}", "{w} {email}, {w}", "mail: {email}. {w}",
    "commit {digest} {w}", "{w} md5 {digest:32} {w}", "sha1: {digest} {w}", "{w} checksum {digest:64}, {w}", "{w} {digest:32} {w}", "uuid {uuid} {w}", "{w} id {uuid}. {w}", "{w} {uuid} {w}", "session {uuid}, {w}", "ISBN {isbn} {w}", "{w} isbn: {isbn:ten}, {w}", "{w} {isbn} {w}", "version {version} {w}", "{w} v{version} {w}", "{w} {version}, {w}",
    "{w} order {number} {w}", "order no. {number:long} {w}", "{w} {number}, {w}", "page {number:short} of {number:short} {w}", "{w} {number:short} {number:short} {number:short} {w}", "| {number:short} | {number} | {number:short} |", "{w} item #{number} ({w} {number:short}) {w}", "invoice {serial} {w}", "tracking {serial:long} {w}", "{w} {serial}, {w}", "{w} part {range} {w}", "{w} {range} {w}", "{w} {range:three} {w}", "lines {range} {w}",
    "{w} {date} {w}", "{w} on {date:slash}, {w}", "{w} {date:dots} {w}", "{date}T{time} {w}", "at {time} {w}", "{w} {time:short} - {time:short} {w}", "{w} {price} {w}", "{w} ${price}, {w}", "{w} {decoy} {w}", "{w} {decoy}, {w}", "card {decoy} {w}", "{w} {decoy:split} {w}", "{w} 0000000000000000 {w}", "{w} 1234567890 {w}", "@{w} and @{w} {w}", "{w} x1 y2 z3 {w}", "{w} the 1st and 2nd {w}", "a 55% {w}", "room 101-B {w}", "under CC BY-NC 4.0. {w}", "{w}, Version 2.0. {w}", "chapter 3.2.1 {w}", "C3H8O2 {w} H2O {w}", "{w} 3x4x5 {w}", "{w} 10^6 + 2*10^3 = {number} {w}", "build {digest:short} {w}", "{w} doi 10.{number:short}/{serial} {w}", "account {number:long} {w}", "file_{number:short}_{date}.txt {w}",
)


def values(rng: np.random.Generator) -> dict:
    """Generators of values by kind and notation."""
    num = lambda n: "".join(str(d) for d in rng.integers(0, 10, n))
    lead = lambda n: f"{rng.integers(1, 10)}{num(n - 1)}"
    letters = lambda n, a="abcdefghijklmnopqrstuvwxyz": "".join(rng.choice(list(a), n))
    some = lambda low, high: int(rng.integers(low, high))
    pick = lambda *xs: xs[some(0, len(xs))]
    lower, upper = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    hexes, both = "0123456789abcdef", lower + upper + "0123456789"

    def card(good: bool = True) -> str:
        body = f"{some(2, 7)}{num(14 if good else some(13, 17))}"
        return body + next(c for c in "0123456789" if _luhn(body + c) == good)

    four = lambda s, by: by.join(re.findall(".{4}", s[:16]))
    version = lambda: ".".join(str(some(0, 30)) for _ in range(some(2, 4)))
    return {
        "w": lambda: " ".join(letters(some(2, 9)) for _ in range(some(1, 4))),
        "secret": lambda: letters(pick(32, 40, 40, 48), hexes),
        "secret:key": lambda: pick("sk", "pk", "ghp", "tok", letters(3), letters(4)) + pick("_", "-", "_live_") + letters(some(20, 40), both),
        "secret:mixed": lambda: letters(some(20, 44), both),
        "secret:upper": lambda: pick("AKIA", "ASIA", letters(4, upper)) + letters(16, upper + "0123456789"),
        "secret:jwt": lambda: ".".join("eyJ" * (k < 2) + letters(some(18, 40), both + "_-") + letters(2, both) for k in range(3)),
        "phone": lambda: f"+1 ({lead(3)}) {lead(3)}-{num(4)}",
        "phone:plain": lambda: f"+{lead(2)} {num(3)} {num(7)}",
        "phone:local": lambda: f"({lead(3)}) {lead(3)}-{num(4)}",
        "phone:dash": lambda: f"{lead(3)}-{lead(3)}-{num(4)}",
        "phone:dots": lambda: f"{lead(3)}.{lead(3)}.{num(4)}",
        "phone:zero": lambda: pick(lambda: f"0{num(2)} {num(4)} {num(4)}", lambda: f"0{num(4)} {num(6)}", lambda: " ".join(["0" + num(1), *(num(2) for _ in range(4))]), lambda: f"0{num(3)}/{num(7)}")(),
        "card": card, "card:split": lambda: four(card(), " "), "card:dash": lambda: four(card(), "-"),
        "ssn": lambda: f"{some(100, 666)}-{some(10, 99)}-{some(1000, 9999)}",
        "ip": lambda: ".".join(str(x) for x in rng.integers(1, 256, 4)),
        "ip:six": lambda: pick(lambda: ":".join(letters(some(1, 5), hexes) for _ in range(8)), lambda: f"2001:db8:{letters(some(1, 5), hexes)}::{letters(some(1, 5), hexes)}", lambda: f"fe80::{letters(4, hexes)}:{letters(3, hexes)}:{letters(4, hexes)}")(),
        "email": lambda: f"{letters(6)}.{num(2)}@{letters(5)}{num(1)}.example.com",
        "digest": lambda: letters(40, hexes), "digest:32": lambda: letters(32, hexes), "digest:64": lambda: letters(64, hexes), "digest:short": lambda: letters(some(7, 13), hexes),
        "uuid": lambda: "-".join(letters(n, hexes) for n in (8, 4, 4, 4, 12)),
        "isbn": lambda: f"97{pick('8', '9')}-{num(1)}-{num(2)}-{num(6)}-{num(1)}", "isbn:ten": lambda: f"{num(1)}-{num(3)}-{num(5)}-{num(1)}",
        "version": version, "number": lambda: lead(some(4, 10)), "number:long": lambda: lead(some(9, 14)), "number:short": lambda: lead(some(1, 4)),
        "date": lambda: f"{some(1900, 2030)}-{some(10, 13)}-{some(10, 31)}", "date:slash": lambda: f"{some(1, 32)}/{some(1, 13)}/{some(1900, 2030)}", "date:dots": lambda: f"{some(1, 32):02d}.{some(1, 13):02d}.{some(1900, 2030)}",
        "time": lambda: f"{some(0, 24):02d}:{some(0, 60):02d}:{some(0, 60):02d}", "time:short": lambda: f"{some(0, 24)}:{some(0, 60):02d}",
        "decoy": lambda: card(False), "decoy:split": lambda: four(card(False), " "),
        "serial": lambda: letters(some(2, 4), upper) + pick("", "-") + num(some(4, 9)), "serial:long": lambda: letters(2, upper) + num(9) + letters(2, upper),
        "price": lambda: f"{lead(some(1, 4))}{pick('.', ',')}{num(2)}", "range": lambda: f"{lead(some(1, 5))}-{lead(some(1, 5))}", "range:three": lambda: f"{lead(3)}-{lead(3)}-{lead(4 - some(1, 3))}",
    }


def labelled_table(lines: Iterable[str] = LINES, copies: int = 8, seed: int = 11) -> list[tuple[str, list[tuple[int, int, str]]]]:
    """The small labelled table: patterns of lines in which {kind:notation} stands for a value, filled by a seeded generator."""
    value = values(np.random.default_rng(seed))
    table = []
    for line in lines:
        for _ in range(copies):
            text, spans = "", []
            for part in re.split(r"(\{[^}]*\})", line):
                if part.startswith("{"):
                    made, kind = value[part[1:-1]](), part[1:-1].split(":")[0]
                    if kind in KINDS:
                        spans.append((len(text), len(text) + len(made), kind))
                    part = made
                text += part
            table.append((text, spans))
    return table


def crf_spans(model: Crf, texts: list[str]) -> list[list[Span]]:
    """Spans that the chain finds in each text."""
    batch = [(k, x) for k, text in enumerate(texts) for x in islands(text)]
    out: list[list[Span]] = [[] for _ in texts]
    for (k, x), path in zip(batch, model.decode([x for _, x in batch]), strict=True):
        open_ = None
        for (a, b), label in zip(x.places[x.first : x.last], [LABELS[i] for i in path], strict=True):
            if label[0] == "I" and open_ is not None:
                open_[2] = b
                continue
            if open_ is not None:
                out[k].append(tuple(open_))
            open_ = [a, KINDS.index(label[2:]), b] if label != "O" else None
        if open_ is not None:
            out[k].append(tuple(open_))
    return out


def sound(text: str, span: Span) -> bool:
    """Whether a span of the chain is what its kind has to be."""
    kind, own = KINDS[span[1]], text[span[0] : span[2]]
    digits = "".join(_DIGIT.findall(own))
    if kind == "card":
        return 13 <= len(digits) <= 19 and _luhn(digits)
    if kind == "ip":
        try:
            return bool(ipaddress.ip_address(own))
        except ValueError:
            return False
    if kind == "phone":
        return 9 <= len(digits) <= 15 and not set(own) - set("0123456789 ()+./-")
    if kind == "ssn":
        return bool(re.fullmatch(r"(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}", own))
    if kind == "secret":
        return len(own) >= 16 and bool(digits) and any(c.isalpha() for c in own) and not _SPACE.search(own)
    return True


def apart(more: list[Span], base: list[Span]) -> list[Span]:
    """The spans of `more` that touch none of `base`; both are in order."""
    out, at = [], 0
    ends = np.maximum.accumulate([b for _, _, b in base]) if base else []
    for s in more:
        while at < len(base) and ends[at] <= s[0]:
            at += 1
        if at == len(base) or base[at][0] >= s[2]:
            out.append(s)
    return out


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


SCHEMA = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long, n_spans long"


def find_pii(docs: DataFrame, model: Crf | None = None) -> DataFrame:
    """One row per document. Counts and base_sha256 are those of the base patterns; spans has all, n_spans of them, n_added from the CRF.

    A CRF span that touches a base span is dropped, so base spans stay as they are, and so is one that is
    not sound().
    """
    model = model or train(labelled_table())
    small_batches(docs.sparkSession)
    schema = [(name, pa.string() if kind == "string" else pa.int64()) for name, kind in (x.split() for x in SCHEMA.split(", "))]

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [x or "" for x in b.column("text").to_pylist()]
            rows = []
            for text, base, more in zip(texts, map(base_spans, texts), crf_spans(model, texts), strict=True):
                added = [s for s in apart(more, base) if sound(text, s)]
                counts = [sum(k == i for _, k, _ in base) for i in range(len(BASE_KINDS))]
                rows.append((*counts, hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(sorted(base + added)), len(added), len(base) + len(added)))
            columns = zip(*rows, strict=True) if rows else [[]] * len(schema[1:])
            yield pa.RecordBatch.from_arrays([b.column("doc_id").cast(pa.int64()), *(pa.array(c, t) for c, (_, t) in zip(columns, schema[1:], strict=True))], schema=pa.schema(schema))

    return docs.select("doc_id", "text").mapInArrow(find, SCHEMA)


def op1_pii_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_pii(documents(spark, sf_dir))


QUERIES = {"op1_pii_crf": op1_pii_crf}
