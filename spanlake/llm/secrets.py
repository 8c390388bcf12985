"""Secret scans: base patterns, and spans that a linear-chain conditional random field adds.

Tokens are tagged begin, inside or outside of a secret, from their shape, the words near them
and features of the file, and decoded by Viterbi; each line is a chain. Shape and entropy are those
of the whole token, and neighbours are the tokens before and behind it, also on other lines. A
secret begins at a token of at least six ASCII characters and goes on through ASCII tokens; all
else is up to the weights. What a distinct token adds to the scores is kept in a bounded memo. A
bound on what any span could gain tells lines for which "all outside" is the best path; only
the others are decoded.

The weights are trained here, on at most ``SAMPLE_SEGMENTS`` runs of up to ``SEGMENT`` tokens and
``SEGMENT_CHARS`` characters of a line, a third each with base spans, with digits or key words, and
with neither; chosen by a hash of their content, so neither the order nor the number of partitions
matters. Tokens that look like a secret which no base pattern knows are no example of what isn't one:
such runs are left out. Lines made from fixed templates are added. The base spans always stay;
the field adds spans that don't meet them.

Defined cases: null and empty texts have no spans; repeated rows and null identifiers keep a
row each; without lines to learn from, the templates alone are used; an empty table gives an
empty result; other columns are ignored. Places are code points, ends exclusive.
"""

from __future__ import annotations

import hashlib
import math
import re
import string
import zlib
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import row_batches, staged, unstage

KINDS = ("assign", "access", "hex", "crf")
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ACCESS, _HEX = re.compile(r"AKIA[A-Z0-9]+"), re.compile(r"[0-9a-f]{24,}")

SAMPLE_SEGMENTS, SEGMENT, SEGMENT_CHARS, FEATURES, ROUNDS = 1_500, 40, 2_000, 1 << 13, 60
#: Tokens before that count as near, distinct tokens and their characters that a worker keeps, characters of a text tagged at once.
NEAR, MEMO_TOKENS, MEMO_CHARS, BLOCK_CHARS = 4, 300_000, 16_000_000, 1_000_000
B_TAG, I_TAG, O_TAG = 0, 1, 2
_TOKEN = re.compile(r"\n|[A-Za-z0-9+/_.\-]+=*|[=:\"'`]|[^\sA-Za-z0-9+/_.\-=:\"'`]+")
_KEY = re.compile(r"passw|passwd|pwd|secret|token|api.?key|credential|bearer|authorization|private|access.?key", re.I | re.A)
_KEYS_LOW = ("passw", "pwd", "secret", "token", "api", "credential", "bearer", "authorization", "private", "access")
_DIGIT, _HEX_ONLY = re.compile(r"[0-9]"), re.compile(r"[0-9a-f]{16,}", re.I | re.A)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the base patterns, by start and kind."""
    found: list[tuple[str, int, int]] = []
    low = text.lower()
    if any(k in low for k in ("passw", "secret", "token", "api")):
        found += [("assign", m.start(), m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [("access", m.start(), m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [("hex", m.start(), m.end()) for m in _HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


_CLASSES = str.maketrans(string.digits + string.ascii_lowercase + string.ascii_uppercase, "d" * 10 + "x" * 26 + "X" * 26)
_WIDE = re.compile(r"[^\x00-\x7f]")


def shape(token: str) -> str:
    """Classes of the first and the last character, all classes, and how often they change (as a power of two)."""
    if token.isascii() and token.isalpha() and token.islower():
        return "xxx0"
    kinds = _WIDE.sub("u", token).translate(_CLASSES)
    changes = sum(a != b for a, b in zip(kinds, kinds[1:]))
    return f"{kinds[:1]}{kinds[-1:]}{''.join(sorted(set(kinds)))}{changes.bit_length()}"


_C_LOG_C = [0.0, 0.0, *(c * math.log2(c) for c in range(2, 64))]


def _entropy(token: str) -> float:
    """Bits of a character, from how often each occurs."""
    n, distinct = len(token), set(token)
    if n < 64:
        return (math.log2(n) - sum([_C_LOG_C[token.count(c)] for c in distinct]) / n if len(distinct) < n else math.log2(n)) if n else 0.0
    return math.log2(n) - sum(c * math.log2(c) for c in Counter(token).values() if c > 1) / n


def can_begin(token: str) -> bool:
    """Whether a secret may begin at a token."""
    return len(token) >= 6 and token.isascii() and (token[0].isalnum() or token[0] in "+/_")


def secret_like(token: str) -> bool:
    """A token of a form that secrets have: long, of letters and digits mixed, and no words or addresses."""
    return len(token) >= 16 and not re.search(r"[./].*[./]|[^\x00-\x7f]", token) and any(c.isdigit() for c in token) and any(c.isalpha() for c in token) and _entropy(token) >= 3.2


def own_features(t: str) -> list[str]:
    """What a token is itself."""
    low, n = t.lower(), max(1, len(t))
    return [
        "bias", f"shape={shape(t)}", f"length={min(n // 4, 12)}", f"entropy={round(2 * _entropy(t))}",
        f"digits={round(4 * len(_DIGIT.findall(t)) / n)}", f"dots={'.' in t}",
        f"mixed={t != low and t != t.upper()}", f"hex={bool(_HEX_ONLY.fullmatch(t))}",
        f"head={low[:3]}", f"iskey={bool(_KEY.search(t))}",
    ]


def token_features(tokens: Sequence[str], i: int, file: list[str], before: Sequence[str] = (), after: str = "") -> list[str]:
    """All features of token ``i``, between tokens ``before`` and ``after`` of other lines."""
    around = [*[""] * NEAR, *before][-NEAR:] + [*tokens, after]
    at = i + NEAR
    key = any(_KEY.search(x) for x in around[i:at])
    sign = any(x in ("=", ":") for x in around[at - 2 : at])
    return [
        *own_features(tokens[i]), f"before={around[at - 1].lower()}", f"before2={around[at - 2].lower()}", f"after={around[at + 1].lower()}",
        f"key={key}", f"sign={sign}", *[f"{f}&key={key}" for f in file],
    ]


def file_features(text: str) -> list[str]:
    """How dense assignments and addresses are, and how long the file is."""
    n = max(1, len(text))
    return [f"eq={min(3, 2000 * text.count('=') // n)}", f"size={min(6, int(math.log10(n)))}", f"at={min(3, 2000 * text.count('@') // n)}"]


def _ids(features: list[str]) -> list[int]:
    return [1 + zlib.crc32(f.encode("utf-8", "surrogatepass")) % (FEATURES - 1) for f in features]


def _id(feature: str) -> int:
    return _ids([feature])[0]


def _keyed(t: str, low: str) -> bool:
    """Whether a token names a key; the pattern is only asked where one of its words stands."""
    return len(low) > 2 and any([k in low for k in _KEYS_LOW]) and bool(_KEY.search(t))


# ids of features of few values, and what a checksum is behind a feature's name
_BIAS, _NOT_YES = _id("bias"), (False, True)
_LENGTHS, _DIGITS, _ENTROPIES = [_id(f"length={k}") for k in range(13)], [_id(f"digits={k}") for k in range(5)], [_id(f"entropy={k}") for k in range(64)]
_DOTS, _MIXED, _HEXED, _ISKEY = ([_id(f"{name}={k}") for k in _NOT_YES] for name in ("dots", "mixed", "hex", "iskey"))
_HEAD, *_AROUND = (zlib.crc32(name) for name in (b"head=", b"before=", b"before2=", b"after="))
_SHAPES: dict[str, int] = {}


def fast_ids(t: str) -> tuple[list[int], list[int], bool]:
    """The ids of ``own_features``, those of a token as a neighbour (before, second before, behind), and whether it names a key."""
    low, n = t.lower(), max(1, len(t))
    wide = low.encode("utf-8", "surrogatepass")
    head = wide[:3] if len(wide) == len(low) else low[:3].encode("utf-8", "surrogatepass")
    key = _keyed(t, low)
    plain = low == t and t.isascii() and t.isalpha()
    form = "xxx0" if plain else shape(t)
    shaped = _SHAPES.get(form)
    if shaped is None:
        shaped = _id(f"shape={form}")
        if len(_SHAPES) < 4_096:
            _SHAPES[form] = shaped
    bits = round(2 * _entropy(t))
    own = [
        _BIAS, shaped, _LENGTHS[min(n // 4, 12)], _ENTROPIES[bits] if bits < 64 else _id(f"entropy={bits}"), _DIGITS[0 if plain else round(4 * len(_DIGIT.findall(t)) / n)], _DOTS["." in t],
        _MIXED[not plain and t != low and t != t.upper()], _HEXED[n >= 16 and bool(_HEX_ONLY.fullmatch(t))], 1 + zlib.crc32(head, _HEAD) % (FEATURES - 1), _ISKEY[key],
    ]
    return own, [1 + zlib.crc32(wide, c) % (FEATURES - 1) for c in _AROUND], key


class _Known(dict):
    """Numbers of tokens in the order in which they are met first; ``new`` lists those since it was emptied."""

    def __init__(self):
        self.new: list[str] = []

    def __missing__(self, token: str) -> int:
        self.new.append(token)
        self[token] = n = len(self)
        return n


class Field:
    """A linear-chain conditional random field over hashed features; tags begin, inside, outside."""

    def __init__(self, weights: np.ndarray, moves: np.ndarray):
        self.weights, self.moves = weights, moves
        self.of_file: dict[tuple[str, ...], tuple[np.ndarray, np.ndarray]] = {}
        self._forget()

    def _forget(self) -> None:
        self.known = _Known()
        self.chars = 0
        # of each distinct token: what it adds itself, as the one before, as the second before, as the one behind
        self.parts, self.flags = np.zeros((4, 1024, 3)), np.zeros((4, 1024), bool)

    def _sum(self, features: list[str]) -> np.ndarray:
        return self.weights[_ids(features)].sum(axis=0)

    def _numbers(self, tokens: list[str]) -> np.ndarray:
        return np.fromiter(map(self.known.__getitem__, tokens), np.int64, len(tokens))

    def _rows(self, tokens: list[str]) -> np.ndarray:
        rows = self._numbers(tokens)
        if len(self.known) > MEMO_TOKENS or self.chars > MEMO_CHARS:
            self._forget()
            rows = self._numbers(tokens)
        added, self.known.new = self.known.new, []
        while len(self.known) > self.parts.shape[1]:
            self.parts, self.flags = np.concatenate([self.parts, np.zeros_like(self.parts)], axis=1), np.concatenate([self.flags, np.zeros_like(self.flags)], axis=1)
        first = len(self.known) - len(added)
        for i in range(0, len(added), 4_096):
            part = added[i : i + 4_096]
            at = slice(first + i, first + i + len(part))
            own, around, flags = [], [], []
            for t in part:
                mine, near, key = fast_ids(t)
                own.append(mine)
                around.append(near)
                flags.append((can_begin(t), t.isascii(), key, t in ("=", ":")))
                self.chars += len(t)
            self.parts[0, at] = self.weights[np.array(own)].sum(axis=1)
            self.parts[1:, at] = self.weights[np.array(around)].swapaxes(0, 1)
            self.flags[:, at] = np.array(flags).T
        return rows

    def _of_file(self, file: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """What a key nearby and a sign before add in a file; files' features have few values."""
        found = self.of_file.get(tuple(file))
        if found is None:
            found = np.stack([self._sum([f"key={k}", *[f"{f}&key={k}" for f in file]]) for k in (False, True)]), np.stack([self._sum([f"sign={k}"]) for k in (False, True)])
            if len(self.of_file) < 1_000:
                self.of_file[tuple(file)] = found
        return found

    def scores(self, tokens: list[str], file: list[str], before: Sequence[str] = (), after: str = "") -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The score of each tag of each token, and which tokens can begin and continue a secret."""
        n, at = len(tokens), NEAR
        rows = self._rows([*[*[""] * NEAR, *before][-NEAR:], *tokens, after])
        begins, inside, key, sign = self.flags
        own, first, second, behind = self.parts
        keyed, signs = key.take(rows), sign.take(rows)
        near = keyed[0:n] | keyed[1 : n + 1] | keyed[2 : n + 2] | keyed[3 : n + 3]
        signed = signs[at - 1 : at - 1 + n] | signs[at - 2 : at - 2 + n]
        of_key, of_sign = self._of_file(file)
        here = rows[at : at + n]
        e = own.take(here, axis=0)
        e += first.take(rows[at - 1 : at - 1 + n], axis=0)
        e += second.take(rows[at - 2 : at - 2 + n], axis=0)
        e += behind.take(rows[at + 1 : at + 1 + n], axis=0)
        e += of_key.take(near, axis=0)
        e += of_sign.take(signed, axis=0)
        return e, begins[here], inside[here]

    def path(self, e: np.ndarray, begins: np.ndarray, inside: np.ndarray) -> list[int]:
        """Viterbi over one line. Inside follows begin or inside only; of equal paths the one outside."""
        m, back = self.moves.tolist(), []
        best = [-math.inf, -math.inf, 0.0]
        for (b, i, o), can, may in zip(e.tolist(), begins.tolist(), inside.tolist()):
            from_b, from_i, from_o = best
            to = []
            for tag, gain, able in ((B_TAG, b, can), (I_TAG, i, may), (O_TAG, o, True)):
                ways = [(from_o + m[O_TAG][tag], O_TAG)] if tag != I_TAG else []
                ways += [(from_i + m[I_TAG][tag], I_TAG), (from_b + m[B_TAG][tag], B_TAG)]
                v, p = max(ways, key=lambda w: w[0])
                to.append((v + gain if able else -math.inf, p))
            best = [v for v, _ in to]
            back.append([p for _, p in to])
        tags = [max((O_TAG, I_TAG, B_TAG), key=lambda t: best[t])] if back else []
        for pointers in reversed(back[1:]):
            tags.append(pointers[tags[-1]])
        return tags[::-1]

    def tag(self, tokens: list[str], file: list[str], before: Sequence[str] = (), after: str = "") -> list[int]:
        """The tags of one line."""
        return self.path(*self.scores(tokens, file, before, after))

    def open_tokens(self, e: np.ndarray, begins: np.ndarray, inside: np.ndarray, heads: np.ndarray) -> np.ndarray:
        """Tokens at which a span might begin: no path gains by one elsewhere. ``heads`` are the first tokens of lines.

        A span gains at most the best way in, its own scores, and the best way out."""
        r = self.moves - self.moves[O_TAG, O_TAG]
        d = e - e[:, O_TAG :]
        step = np.where(inside & ~heads, max(r[B_TAG, I_TAG], r[I_TAG, I_TAG]) + d[:, I_TAG], -1e4)
        total = np.cumsum(step)
        further = np.maximum.accumulate(total[::-1])[::-1] - total
        way_in, way_out = r[:, B_TAG].max(), max(r[B_TAG, O_TAG], r[I_TAG, O_TAG], 0.0)
        return begins & (way_in + d[:, B_TAG] + further + way_out > -1e-6)


class Example(NamedTuple):
    """Tokens of a line with their tags, what stands before and behind them, and features of the file."""

    tokens: list[str]
    tags: list[int]
    file: list[str]
    before: Sequence[str] = ()
    after: str = ""


def train(examples: list[Example], rounds: int = ROUNDS, decay: float = 1e-3) -> Field:
    """Maximum likelihood with shrinkage by adaptive gradient steps on all examples at once."""
    examples = [x for x in examples if x.tokens]
    n, width = len(examples), max(len(x.tokens) for x in examples)
    per = len(token_features(["a"], 0, examples[0].file))
    x, y, live = np.zeros((n, width, per), np.int32), np.full((n, width), O_TAG), np.zeros((n, width), bool)
    for k, (tokens, tags, file, before, after) in enumerate(examples):
        for i in range(len(tokens)):
            x[k, i] = _ids(token_features(tokens, i, file, before, after))
        y[k, : len(tags)], live[k, : len(tags)] = tags, True
    w, m = np.zeros((FEATURES, 3)), np.zeros((3, 3))
    sw, sm = np.full_like(w, 1e-8), np.full_like(m, 1e-8)
    truth = np.eye(3)[y] * live[..., None]
    flat = x.reshape(-1)
    lse = np.logaddexp.reduce
    for _ in range(rounds):
        e = w[x].sum(axis=2) * live[..., None]
        f, b = np.zeros((n, width, 3)), np.zeros((n, width, 3))
        f[:, 0] = e[:, 0]
        for i in range(1, width):
            on = live[:, i, None]
            f[:, i] = np.where(on, lse(f[:, i - 1, :, None] + m, axis=1) + e[:, i], f[:, i - 1])
        for i in range(width - 2, -1, -1):
            on = live[:, i + 1, None]
            b[:, i] = np.where(on, lse(m + (e[:, i + 1] + b[:, i + 1])[:, None, :], axis=2), b[:, i + 1])
        z = lse(f[:, -1], axis=1)
        chance = np.exp(f + b - z[:, None, None]) * live[..., None]
        diff = truth - chance
        g = np.stack([np.bincount(flat, np.repeat(diff[..., c].reshape(-1), per), FEATURES) for c in range(3)], axis=1) / n - decay * w
        gm = -decay * m
        for i in range(1, width):
            on = live[:, i, None, None]
            pair = np.exp(f[:, i - 1, :, None] + m + (e[:, i] + b[:, i])[:, None, :] - z[:, None, None]) * on
            gm += (truth[:, i - 1, :, None] * truth[:, i, None, :] * on - pair).sum(axis=0) / n
        sw += g * g
        sm += gm * gm
        w += 0.3 * g / np.sqrt(sw)
        m += 0.3 * gm / np.sqrt(sm)
        w[0] = 0
    return Field(w, m)


_ALNUM, _LOW = string.ascii_letters + string.digits, string.ascii_lowercase + string.digits
_FRAMES = ['password is "{}"', "secret key {} here", "Authorization: Bearer {}", "export ACCESS_KEY={}", "credential : {} ."]
_PLAIN = (
    "the secret of the token is a password policy", "a private garden behind the house", "tokens are counted before they are sent", "the password must be changed every second month", "bearer of good news today",
    "credentials were checked at the entrance", "access to the archive is limited", "reset your password yesterday evening please",
)


def drawn(seed: str, alphabet: str, n: int) -> str:
    """A text of ``n`` letters that follows from the seed."""
    stream = hashlib.shake_256(seed.encode()).digest(2 * n)
    return "".join(alphabet[b % len(alphabet)] for b in stream[:n])


def template_lines(first: int, last: int, frames: Sequence[str] = tuple(_FRAMES)) -> list[tuple[str, str]]:
    """(line, secret) of common forms, and lines (with an empty secret) of what only looks like one. A secret
    may stand on the line below its key."""
    out = []
    for k in range(first, last):
        secrets = [
            "ghp_" + drawn(f"g{k}", _ALNUM, 36), "sk_live_" + drawn(f"s{k}", _ALNUM, 24), "AKIA" + drawn(f"a{k}", string.ascii_uppercase + string.digits, 16),
            "xoxb-" + drawn(f"x{k}", string.digits, 12) + "-" + drawn(f"y{k}", _ALNUM, 24), "eyJ" + drawn(f"e{k}", _ALNUM, 30) + "." + drawn(f"f{k}", _ALNUM, 40),
            drawn(f"h{k}", "0123456789abcdef", 40), drawn(f"b{k}", _ALNUM + "+/", 42) + "==", drawn(f"p{k}", _LOW, 10) + str(k),
        ]
        for s in secrets:
            strong = len(s) >= 16
            ways = [*frames, "password:\n{}"] + (["see {} for it", "key {}"] if strong else [])
            out.append((ways[zlib.crc32(f"{k}{s}".encode()) % len(ways)].format(s), s))
        weak = (drawn(f"l{k}", string.ascii_letters, 14), drawn(f"n{k}", string.digits, 12))
        out += [(("password:\n{}", "secret key {} here", "access token = {}")[k % 3].format(s), s) for s in weak]
        mail = f"{drawn(f'm{k}', string.ascii_lowercase, 5)}.{k}@mail{k % 9}.example.com"
        for plain in (
            f"write to {mail} today", f"on 2024-0{k % 9 + 1}-1{k % 9} at 1{k % 9}:30", f"host 10.2.{k}.1{k} was down", f"call 555-01{k:02d}-{k + 1000}",
            f"see http://www.example{k}.org/a/page{k}.html now", f"version v{k}.2.1-rc{k} of lib{k}", f"chapter{k} part2b of item{k}x", f"order {drawn(f'o{k}', string.digits, 9)} was sent", _PLAIN[k % len(_PLAIN)],
        ):
            out.append((plain, ""))
    return out


def templates() -> list[Example]:
    """Examples from the template lines; always the same."""
    made = []
    for text, secret in template_lines(0, 20):
        head, _, line = text.rpartition("\n")
        marks = list(_TOKEN.finditer(line))
        at = line.find(secret)
        made.append(Example([m[0] for m in marks], _tags(marks, [(at, at + len(secret))] if secret else []), file_features(text), _TOKEN.findall(head)))
    return made


def _tags(marks: list[re.Match], spans: list[tuple[int, int]]) -> list[int]:
    """Tags of tokens in order, from sorted spans that don't overlap."""
    tags, last, k = [], None, 0
    for m in marks:
        while k < len(spans) and spans[k][1] <= m.start():
            k += 1
        inside = spans[k] if k < len(spans) and spans[k][0] < m.end() else None
        tags.append(O_TAG if inside is None else I_TAG if inside == last else B_TAG)
        last = inside
    return tags


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The union of spans, as sorted spans that don't overlap."""
    out: list[tuple[int, int]] = []
    for i, j in sorted(spans):
        if out and i < out[-1][1]:
            out[-1] = (out[-1][0], max(j, out[-1][1]))
        else:
            out.append((i, j))
    return out


def _blocks(text: str) -> Iterator[tuple[int, int]]:
    """(begin, end) of parts of whole lines."""
    at = 0
    while at < len(text):
        end = text.find("\n", at + BLOCK_CHARS)
        end = len(text) if end < 0 else end + 1
        yield at, end
        at = end


def field_spans(text: str, field: Field) -> list[tuple[int, int]]:
    """Spans of the secrets that the field tags."""
    spans, before = [], [""] * NEAR
    file = file_features(text)
    for begin, end in _blocks(text):
        found = _TOKEN.findall(text, begin, end)
        breaks = np.array([i for i, t in enumerate(found) if t == "\n"], np.int64)
        tokens = [t for t in found if t != "\n"] if len(breaks) else found
        if not tokens:
            continue
        # a break is as many tokens in as there are others before it
        line = np.searchsorted(breaks - np.arange(len(breaks)), np.arange(len(tokens)), side="right")
        behind = next((m[0] for m in _TOKEN.finditer(text, end) if m[0] != "\n"), "")
        e, begins, inside = field.scores(tokens, file, before, behind)
        heads = np.diff(line, prepend=-1) > 0
        before = [*before, *tokens[-NEAR:]][-NEAR:]
        lines = np.unique(line[field.open_tokens(e, begins, inside, heads)])
        if not len(lines):
            continue
        marks = [m.span() for m in _TOKEN.finditer(text, begin, end) if m[0] != "\n"]
        for lo, hi in zip(np.searchsorted(line, lines).tolist(), np.searchsorted(line, lines, side="right").tolist()):
            for at, tag in zip(marks[lo:hi], field.path(e[lo:hi], begins[lo:hi], inside[lo:hi])):
                if tag == B_TAG:
                    spans.append(at)
                elif tag == I_TAG:
                    spans[-1] = (spans[-1][0], at[1])
    return spans


def _segments(text: str) -> Iterator[tuple[list[str], list[int] | None, list[str], str]]:
    """Runs of up to ``SEGMENT`` tokens of a line: tokens, tags (None: all outside), tokens before, token behind."""
    spans = []
    for kind, i, j in base_spans(text):
        spans.append((_ASSIGN.match(text, i).start(2) if kind == "assign" else i, j))
    found = list(_TOKEN.finditer(text)) if spans else _TOKEN.findall(text)
    tags = _tags(found, merged(spans)) if spans else None
    words = [m[0] for m in found] if spans else found
    tokens = [t for t in words if t != "\n"]
    if tags:
        tags = [y for y, t in zip(tags, words) if t != "\n"]
    at, k = 0, 0
    breaks = [i for i, t in enumerate(words) if t == "\n"]
    for stop in [i - n for n, i in enumerate(breaks)] + [len(tokens)]:
        for k in range(at, stop, SEGMENT):
            end = min(k + SEGMENT, stop)
            yield tokens[k:end], tags[k:end] if tags else None, tokens[max(0, k - NEAR) : k], tokens[end] if end < len(tokens) else ""
        at = stop


_SAMPLED = "class int, place long, tokens array<string>, before array<string>, after string, tags array<int>, file array<string>"


def sampled(docs: DataFrame, per_class: int) -> DataFrame:
    """Of each task the ``per_class`` runs of each class whose content has the smallest hashes, each content once."""

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[dict[tuple, tuple]] = [{}, {}, {}]
        limit = [1 << 32] * 3

        def prune(c: int) -> None:
            kept = sorted(best[c])[:per_class]
            best[c] = {k: best[c][k] for k in kept}
            limit[c] = kept[-1][0] if len(kept) == per_class else 1 << 32

        for b in row_batches(batches):
            for text in b.column(0).to_pylist():
                text = text or ""
                low = text.lower()
                keyed, file = any(k in low for k in _KEYS_LOW), None
                for tokens, tags, before, after in _segments(text):
                    content = " ".join(tokens)
                    place = zlib.crc32(content.encode("utf-8", "surrogatepass"))
                    has = tags is not None and min(tags) != O_TAG
                    if place > (limit[0] if has else max(limit[1:])) or len(content) > SEGMENT_CHARS:
                        continue
                    c = 0 if has else 1 if _DIGIT.search(content) or (keyed and _KEY.search(content)) else 2
                    if place > limit[c] or any(secret_like(t) for t, y in zip(tokens, tags or [O_TAG] * len(tokens)) if y == O_TAG):
                        continue
                    file = file or file_features(text)
                    tags = [B_TAG if y == I_TAG and not i else y for i, y in enumerate(tags)] if tags else [O_TAG] * len(tokens)
                    row = (before, after, tags, file)
                    key = (place, tuple(tokens))
                    best[c][key] = min(best[c].get(key, row), row)
                    if len(best[c]) > 4 * per_class:
                        prune(c)
        rows = []
        for c in range(3):
            prune(c)
            rows += [(c, place, list(tokens), *rest) for (place, tokens), rest in best[c].items()]
        kinds = (pa.int32(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.string()), pa.string(), pa.list_(pa.int32()), pa.list_(pa.string()))
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names=[c.split()[0] for c in _SAMPLED.split(", ")])

    return docs.select("text").mapInArrow(pick, _SAMPLED)


def fit(docs: DataFrame, segments: int = SAMPLE_SEGMENTS) -> Field:
    """Trains on at most ``segments`` runs of tokens of the corpus and the templates."""
    per_class = max(1, segments // 3)
    segments_found = staged(sampled(docs, per_class), "segments")
    rest = ["before", "after", "tags", "file"]
    rows = segments_found.groupBy("class", "place", "tokens").agg(F.min(F.struct(*rest)).alias("first")).select("class", "place", "tokens", *[f"first.{c}" for c in rest])
    chosen = []
    for c in range(3):
        chosen += rows.where(F.col("class") == c).orderBy("place", "tokens").limit(per_class).collect()
    unstage(segments_found)
    return train([Example(list(r["tokens"]), list(r["tags"]), list(r["file"]), list(r["before"]), r["after"]) for r in chosen] + templates())


SCANNED = "doc_id long, n_assign long, n_access long, n_hex long, n_crf long, base_sha256 string, spans string"


def added_spans(text: str, field: Field, base: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """The field's spans that meet no base span."""
    taken = merged([(i, j) for _, i, j in base])
    starts = [i for i, _ in taken]
    out = []
    for i, j in field_spans(text, field):
        k = bisect_right(starts, j - 1)
        if not (k and taken[k - 1][1] > i):
            out.append(("crf", i, j))
    return out


def scan_secrets(docs: DataFrame, field: Field) -> DataFrame:
    """One row for each document: counts of each kind, a digest of the base spans, and all spans."""
    weights, moves = field.weights.astype(np.float32), field.moves

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Field(weights.astype(np.float64), moves)
        types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())
        for b in row_batches(batches):
            out: list[tuple] = []
            for doc, text in zip(*(c.to_pylist() for c in b.columns)):
                text = text or ""
                base = base_spans(text)
                more = added_spans(text, own, base)
                joined = ",".join(f"{k}:{i}:{j}" for k, i, j in base)
                every = ",".join(f"{k}:{i}:{j}" for k, i, j in sorted(base + more, key=lambda s: (s[1], KINDS.index(s[0]))))
                n = [sum(s[0] == k for s in base) for k in KINDS[:3]]
                out.append((doc, *n, len(more), hashlib.sha256(joined.encode()).hexdigest(), every))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=[c.split()[0] for c in SCANNED.split(", ")])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(scan, SCANNED)
