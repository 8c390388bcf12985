"""Chat formatting with offset-aligned loss masks.

A conversation is rendered whole, encoded once with offsets, and the sorted spans of its turns
are intersected with the sorted token spans by binary search. The marks are special tokens, so
no token crosses the edge of a turn.

``<|im_start|>role<|im_sep|>text<|im_end|>``

Every mark begins with ``<|``. In texts and roles ``<``, any number of backslashes and ``|``
get one more backslash, so that no text contains a mark; reading takes it away again.

A conversation is rendered and encoded whole, so it is one row of one task. Several are encoded at
once, as many as have ``ENCODED_CHARS`` characters.

Defined cases: null texts and roles count as empty; turns are ordered by turn (null first),
then role and text; repeated turns are kept; a null conv_id is a conversation; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import row_batches
from .tokens import tokenizer_path

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
TOKENIZER = "byte_bpe_50k.json"
_PLAIN, _ESCAPED = re.compile(r"<(\\*)\|"), re.compile(r"<\\(\\*)\|")
_MARK = re.compile("|".join(map(re.escape, (START, SEP, END))))
_TOKENIZERS: dict[str, object] = {}


def escape(text: str) -> str:
    return _PLAIN.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int, str]]]:
    """The formatted conversation, and (start, end, role) of each turn's text in it."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"{START}{escape(role)}{SEP}", escape(text)
        spans.append((at + len(head), at + len(head) + len(body), role))
        parts += [head, body, END]
        at += len(head) + len(body) + len(END)
    return "".join(parts), spans


def parse(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted conversation."""
    turns, at = [], 0
    while at < len(formatted):
        if not formatted.startswith(START, at):
            raise ValueError(f"no turn begins at {at}")
        sep = formatted.index(SEP, at)
        end = formatted.index(END, sep)
        turns.append((unescape(formatted[at + len(START) : sep]), unescape(formatted[sep + len(SEP) : end])))
        at = end + len(END)
    return turns


def chat_tokenizer(path: str):
    """The tokenizer with the marks as special tokens and offsets that keep white space."""
    if path not in _TOKENIZERS:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, processors

        t = Tokenizer.from_file(path)
        t.add_special_tokens([START, SEP, END])
        t.post_processor = processors.ByteLevel(trim_offsets=False)
        _TOKENIZERS[path] = t
    return _TOKENIZERS[path]


def loss_mask(starts: np.ndarray, ends: np.ndarray, spans: list[tuple[int, int]]) -> np.ndarray:
    """Which tokens lie in the sorted spans: both sides of each span by binary search."""
    mask = np.zeros(len(starts), dtype=bool)
    if spans:
        s = np.array(spans)
        for i, j in zip(np.searchsorted(starts, s[:, 0], side="left"), np.searchsorted(ends, s[:, 1], side="right")):
            mask[i:j] = True
    return mask


#: Characters of the conversations that are encoded at once (one conversation at least).
ENCODED_CHARS = 2_000_000
FORMATTED = "conv_id long, formatted string, input_ids array<int>, token_starts array<int>, token_ends array<int>, loss_mask array<boolean>"
_TYPES = (pa.int64(), pa.string(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.bool_()))
_NAMES = [c.split()[0] for c in FORMATTED.split(", ")]


def format_conversations(conversations: DataFrame, tokenizer: str | None = None, loss_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """One row for each conversation: text, ids, offsets (code points) and the mask of the tokens to learn."""
    path = tokenizer or tokenizer_path(TOKENIZER)
    turn = F.struct(
        "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    grouped = conversations.groupBy(F.col("conv_id").cast("long").alias("conv_id")).agg(F.sort_array(F.collect_list(turn)).alias("turns"))

    def encoded(tok, convs: list[int | None], made: list[tuple[str, list[tuple[int, int, str]]]]) -> pa.RecordBatch:
        ids, offsets, masks = [], [], []
        for (_, spans), e in zip(made, tok.encode_batch([m[0] for m in made], add_special_tokens=False)):
            at = np.fromiter(chain.from_iterable(e.offsets), np.int32, 2 * len(e)).reshape(-1, 2)
            ids.append(np.array(e.ids, np.int32))
            offsets.append(at)
            masks.append(loss_mask(at[:, 0], at[:, 1], [(i, j) for i, j, role in spans if role in loss_roles]))
        ends = pa.array(np.cumsum([0, *map(len, ids)]), pa.int32())
        both = np.concatenate(offsets)
        lists = [pa.ListArray.from_arrays(ends, pa.array(np.ascontiguousarray(v))) for v in (np.concatenate(ids), both[:, 0], both[:, 1], np.concatenate(masks))]
        return pa.RecordBatch.from_arrays([pa.array(convs, pa.int64()), pa.array([m[0] for m in made], pa.string()), *lists], names=_NAMES)

    def form(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = chat_tokenizer(path)
        for b in batches:
            convs, made, size = [], [], 0
            for conv, turns in zip(b.column(0), b.column(1)):
                convs.append(conv.as_py())
                made.append(render([(t["role"], t["text"]) for t in turns.as_py()]))
                size += len(made[-1][0])
                if size >= ENCODED_CHARS:
                    yield encoded(tok, convs, made)
                    convs, made, size = [], [], 0
            if made:
                yield encoded(tok, convs, made)

    return grouped.mapInArrow(form, FORMATTED)


def masked_text(text: str, starts: np.ndarray, ends: np.ndarray, mask: np.ndarray) -> str:
    """The text under the mask, unescaped; each unbroken run of tokens on its own."""
    edges = np.flatnonzero(np.diff(np.concatenate([[False], mask, [False]]).astype(np.int8)))
    return "".join(unescape(text[starts[i] : ends[j - 1]]) for i, j in zip(edges[::2], edges[1::2]))


READ_BACK = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_tokens long"


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of what formatted conversations hold: their turns, and the text under the mask."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in row_batches(batches):
            out: list[tuple] = []
            at = b.column(3).offsets.to_numpy()
            starts, ends, mask = (b.column(k).values.to_numpy(zero_copy_only=False) for k in (3, 4, 5))
            for conv, text, i, j in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), at[:-1], at[1:]):
                turns = parse(text)
                whole = "".join(f"{role}\n{content}\n" for role, content in turns)
                loss = masked_text(text, starts[i:j], ends[i:j], mask[i:j])
                digest = [hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in (whole, loss)]
                out.append((conv, len(turns), digest[0], len(loss), digest[1], len(text), int(j - i)))
            if out:
                types = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=[c.split()[0] for c in READ_BACK.split(", ")])

    return formatted.mapInArrow(read, READ_BACK)
