r"""Chat formatting with offset-aligned loss masks.

A conversation is rendered whole: each turn as `<|turn|>role<|says|>text</turn>`. Control
strings inside roles and texts are escaped with backslashes, so the output can be read back
without loss. The rendered text is encoded once, and offsets follow from the tokens' bytes; the
sorted spans of assistant texts are met with the sorted spans of tokens by binary search, which
gives the mask. The control strings are tokens of their own, so no token crosses the border of
a text.

Turns of a conversation are brought together by a shuffle on its id and sorted by turn; rows
stream through, and conversations are encoded some at a time. A single conversation is one
task's work, however long.

Defined cases: null texts and roles count as empty; a row without conversation id is a
conversation of its own, so such rows are spread; ties of turn go by role and text; repeated
rows are turns of their own; an empty table gives no conversations; extra columns play no part.
"""

import hashlib
import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ledgerloom.llm.bpe import BLOCK_CHARS, Encoder, send_vocabulary
from ledgerloom.llm.common import kept_in_process

# The control strings of the template.
TURN, SAYS, END = "<|turn|>", "<|says|>", "</turn>"
CONTROLS = (TURN, SAYS, END, "<|endoftext|>")
_CONTROL = re.compile("|".join(map(re.escape, CONTROLS)))
_ESCAPE = re.compile(r"\\(.)", re.DOTALL)


def escape(text):
    """`text` without control strings: backslashes double, and one follows each opening `<`."""
    return _CONTROL.sub(lambda m: "<\\" + m[0][1:], text.replace("\\", "\\\\"))


def unescape(text):
    return _ESCAPE.sub(r"\1", text)


def render(turns):
    """(formatted text, spans of the assistant texts) of (role, text) turns."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = TURN + escape(role) + SAYS, escape(text)
        if role == "assistant":
            spans.append((at + len(head), at + len(head) + len(body)))
        parts += (head, body, END)
        at += len(head) + len(body) + len(END)
    return "".join(parts), spans


def parse(formatted):
    """The (role, text) turns of a formatted conversation."""
    turns = []
    for part in formatted.split(END)[:-1]:
        role, text = part.removeprefix(TURN).split(SAYS)
        turns.append((unescape(role), unescape(text)))
    return turns


def mask_tokens(offsets, spans):
    """Index ranges of the tokens that lie in each span, by binary search.

    `offsets` are (start, end) of the tokens in order; `spans` are sorted.
    """
    if not len(spans) or not len(offsets):
        return np.zeros((len(spans), 2), dtype=np.int64)
    starts, ends = offsets[:, 0], offsets[:, 1]
    first = np.searchsorted(ends, [s for s, _ in spans], side="right")
    last = np.searchsorted(starts, [e for _, e in spans], side="left")
    return np.stack([first, np.maximum(first, last)], axis=1)


def _encoder(content):
    """The vocabulary with the control strings as tokens, once in a process."""
    key = ("chat", hashlib.sha256(content).digest())
    return kept_in_process(key, lambda: Encoder(content, CONTROLS[:3]))


def token_offsets(text, ids, encoder):
    """(start, end) characters of every token; one within a character has all of it."""
    if not len(ids):
        return np.empty((0, 2), dtype=np.int64)
    ends = np.cumsum(encoder.token_sizes[ids])
    starts = ends - encoder.token_sizes[ids]
    data = np.frombuffer(text.encode(), dtype=np.uint8)
    character = np.cumsum((data & 0xC0) != 0x80) - 1
    return np.stack([character[starts], character[ends - 1] + 1], axis=1)


def format_all(conversations, encoder):
    """(formatted text, ids, offsets, token ranges to learn from) of lists of (role, text)."""
    rendered = [render(turns) for turns in conversations]
    encoded = encoder.encode([formatted for formatted, _ in rendered])
    for (formatted, spans), packed in zip(rendered, encoded):
        ids = np.frombuffer(packed, dtype="<u4")
        offsets = token_offsets(formatted, ids, encoder)
        yield formatted, ids, offsets, mask_tokens(offsets, spans)


def masked_texts(formatted, offsets, ranges):
    """The text under each masked range of tokens, read from the output alone."""
    return [
        unescape(formatted[offsets[a, 0] : offsets[b - 1, 1]]) if b > a else "" for a, b in ranges.tolist()
    ]


def read_back(formatted, offsets, ranges):
    """(turns, digest of them, length and digest of the text under the mask, length) of an output."""
    turns = parse(formatted)
    said = "".join(f"{role}\n{text}\n" for role, text in turns)
    loss = "".join(masked_texts(formatted, offsets, ranges))
    return len(turns), _sha256(said), len(loss), _sha256(loss), len(formatted)


_DIGESTS = "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
_FORMATTED = (
    "conv_id long, formatted string, ids binary, offsets binary, loss_ranges binary, "
    f"read_back struct<{_DIGESTS.replace(' ', ':').replace(',:', ',')}>"
)
_COLUMNS = ["conv_id", "formatted", "ids", "offsets", "loss_ranges", "read_back"]
_NAMES = [c.split()[0] for c in _DIGESTS.split(", ")]


def format_conversations(conversations: DataFrame, path: str) -> DataFrame:
    """(conv_id, formatted, ids, offsets, loss_ranges, read_back) of every conversation.

    `ids` are packed little-endian unsigned 32-bit integers, `offsets` pairs of 64-bit positions,
    one per token, `loss_ranges` pairs of 64-bit token numbers: from, up to which to learn.
    `read_back` has digests of what the other columns give when they are read again.
    """
    vocabulary = send_vocabulary(conversations.sparkSession, path)
    alone = F.col("conv_id").isNull()
    rows = conversations.select(
        "conv_id",
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
        F.when(alone, F.xxhash64("turn", "role", "text")).otherwise(0).alias("apart"),
    )

    def outputs(ids, conversations):
        encoder, out = _encoder(vocabulary.value), []
        for conv_id, found in zip(ids, format_all(conversations, encoder)):
            formatted, tokens, offsets, ranges = found
            digests = dict(zip(_NAMES, read_back(formatted, offsets, ranges)))
            out.append((conv_id, formatted, tokens.tobytes(), offsets.tobytes(), ranges.tobytes(), digests))
        frame = pd.DataFrame(out, columns=_COLUMNS)
        return frame.astype({"conv_id": "Int64"})

    def formats(batches):
        ids, held, size = [], [], 0
        for rows in batches:
            own = [None if pd.isna(x) else int(x) for x in rows["conv_id"]]
            for conv_id, role, text in zip(own, rows["role"], rows["text"]):
                if not ids or conv_id is None or conv_id != ids[-1]:
                    if size >= BLOCK_CHARS:
                        yield outputs(ids, held)
                        ids, held, size = [], [], 0
                    ids.append(conv_id)
                    held.append([])
                held[-1].append((role, text))
                size += len(text)
        if ids:
            yield outputs(ids, held)

    dealt = rows.repartition("conv_id", "apart")
    sorted_rows = dealt.sortWithinPartitions("conv_id", "turn", "role", "text")
    return sorted_rows.select("conv_id", "role", "text").mapInPandas(formats, _FORMATTED)


def _sha256(text):
    return hashlib.sha256(text.encode()).hexdigest()
