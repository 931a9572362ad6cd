"""Chat formatting with a loss mask aligned to token offsets.

A turn is rendered as

    <|im_start|>ROLE<|im_sep|>TEXT<|im_end|>

and a conversation is its turns in order. Inside roles and texts a backslash
goes between `<` and `|`, also where backslashes are there already, so that no
control string can occur and the step can be undone. Control strings are tokens
of their own, as special tokens are: a conversation is encoded once, with the
start byte of every token, and no token reaches over a control string. The mask
then follows by binary search of the sorted spans of assistant texts in the
tokens' starts.

Conversations are dealt by id and read turn by turn in order. One that is larger
than BLOCK_CHARS is rendered in blocks of whole turns, one row each, so that a
task holds a block and not a conversation; since control strings stand between
turns, its tokens are the same.

Defined results: a null role or text is empty; turns come by turn number, nulls
first, then by role and text; repeated rows are turns of their own; rows with a
null conv_id are one conversation; other columns are ignored. An assistant's
empty text has no tokens under the mask.
"""

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitewright.llm.op05_bpe import Encoder, encoder

START, SEP, END = CONTROL = ("<|im_start|>", "<|im_sep|>", "<|im_end|>")
#: A conversation of more characters is written in blocks of about that many.
BLOCK_CHARS = 8_000_000
MASKED_ROLE = "assistant"

BLOCKS = (
    "conv_id long, block int, last boolean, formatted string, ids array<int>, starts array<long>, mask array<boolean>"
)


def escape(text: str) -> str:
    return re.sub(r"<(\\*)\|", r"<\1\\|", text)


def unescape(text: str) -> str:
    return re.sub(r"<(\\*)\\\|", r"<\1|", text)


def render(turns: list[tuple[str, str]]) -> tuple[str, list[str], list[tuple[int, int]]]:
    """The formatted turns, the same cut at control strings, and the byte spans of masked texts in it."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        role, text = escape(role), escape(text)
        start = at + len(START) + len(role.encode()) + len(SEP)
        at = start + len(text.encode()) + len(END)
        if role == MASKED_ROLE:
            spans.append((start, at - len(END)))
        parts += [START, role, SEP, text, END]
    return "".join(parts), parts, spans


def encode(enc: Encoder, parts: list[str]) -> tuple[list[int], np.ndarray]:
    """Ids and start bytes of joined parts, where control strings stand for themselves."""
    first = len(enc.ranks)
    ids: list[int] = []
    sizes: list[int] = []
    for part, own in zip(parts, enc.encode_all(["" if p in CONTROL else p for p in parts])):
        if part in CONTROL:
            ids.append(first + CONTROL.index(part))
            sizes.append(len(part))
        else:
            ids += own
            sizes += map(enc.sizes.__getitem__, own)
    starts = np.array(sizes, dtype=np.int64)
    return ids, np.cumsum(starts) - starts


def mask_of(starts: np.ndarray, spans: list[tuple[int, int]]) -> np.ndarray:
    """Which tokens start within one of the sorted spans."""
    mask = np.zeros(len(starts), dtype=bool)
    if spans:
        edges = np.searchsorted(starts, np.array(spans).ravel()).reshape(-1, 2)
        for a, b in edges.tolist():
            mask[a:b] = True
    return mask


def _ordered(conversations: DataFrame) -> DataFrame:
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    )
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")


def formatted(conversations: DataFrame, ranks: str, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Rows of BLOCKS: a conversation's blocks follow each other; nearly all have one.

    `starts` counts bytes from the block's start; `mask` marks tokens of assistant texts.
    """

    def run(batches):
        enc = encoder(ranks)
        out: list[tuple] = []
        size = held = 0
        turns: list[tuple[str, str]] = []
        key, block = None, 0

        def close(last: bool):
            nonlocal turns, held, block, size
            whole, parts, spans = render(turns)
            ids, starts = encode(enc, parts)
            out.append((key[0], block, last, whole, ids, starts, mask_of(starts, spans)))
            turns, size, held, block = [], size + held, 0, block + 1

        def flush():
            nonlocal size
            columns = list(zip(*out)) or [()] * len(ARROW)
            batch = pa.record_batch([pa.array(c, t) for c, t in zip(columns, ARROW.types)], ARROW.names)
            out.clear()
            size = 0
            return batch

        for batch in batches:
            for conv, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text"))):
                if (conv,) != key:
                    if key:
                        close(True)
                    key, block = (conv,), 0
                elif held > block_chars:
                    close(False)
                if size > 1_000_000:
                    yield flush()
                turns.append((role, text))
                held += len(role) + len(text)
        if key:
            close(True)
        yield flush()

    return _ordered(conversations).mapInArrow(run, BLOCKS)


ARROW = pa.schema(
    [("conv_id", pa.int64()), ("block", pa.int32()), ("last", pa.bool_()), ("formatted", pa.string()),
     ("ids", pa.list_(pa.int32())), ("starts", pa.list_(pa.int64())), ("mask", pa.list_(pa.bool_()))]
)


def turns_of(whole: str) -> list[tuple[str, str]]:
    """The roles and texts of formatted turns."""
    out = []
    for piece in whole.split(END)[:-1]:
        role, _, text = piece.removeprefix(START).partition(SEP)
        out.append((unescape(role), unescape(text)))
    return out


def masked_texts(whole: str, starts: list[int], mask: list[bool]) -> list[str]:
    """What the masked tokens cover, one text per run of them, unescaped."""
    raw = whole.encode()
    flags = np.concatenate([[False], np.array(mask, dtype=bool), [False]])
    edges = np.flatnonzero(flags[1:] != flags[:-1]).reshape(-1, 2)
    stops = [*starts, len(raw)]
    return [unescape(raw[stops[a] : stops[b]].decode()) for a, b in edges.tolist()]


def digests(blocks: DataFrame) -> DataFrame:
    """Per conversation the digests of its turns and of its text under the mask, read back from its blocks.

    Blocks of a conversation must follow each other, as `formatted` leaves them.
    """

    def run(batches):
        state = None
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if state is None:
                    state = [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                turns = turns_of(row["formatted"])
                texts = masked_texts(row["formatted"], row["starts"], row["mask"])
                state[0] += len(turns)
                state[1].update("".join(f"{role}\n{text}\n" for role, text in turns).encode())
                state[2] += sum(map(len, texts))
                state[3].update("".join(texts).encode())
                state[4] += len(row["formatted"])
                if row["last"]:
                    n, all_turns, chars, loss, length = state
                    out.append((row["conv_id"], n, all_turns.hexdigest(), chars, loss.hexdigest(), length))
                    state = None
            columns = list(zip(*out)) or [()] * 6
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
            yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, kinds)], names)

    schema = (
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    )
    return blocks.mapInArrow(run, schema)
