import hashlib

import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st

from tokenizers import AddedToken, Tokenizer, processors

from ledgerloom.llm import chat

PATH = public_tokenizers.path("byte_bpe_50k.json")
TEXT = st.lists(
    st.sampled_from([*chat.CONTROLS, "\\", "<", "|turn|>", "/turn>", " ", "\n", "é", "ab", "日"]), max_size=8
).map("".join)


@pytest.fixture(scope="module")
def encoder():
    with open(PATH, "rb") as file:
        return chat._encoder(file.read())


@pytest.fixture(scope="module")
def library():
    """The library's tokenizer with the control strings as tokens and exact offsets."""
    loaded = Tokenizer.from_file(PATH)
    loaded.add_special_tokens([AddedToken(c, normalized=False, special=True) for c in chat.CONTROLS[:3]])
    loaded.post_processor = processors.ByteLevel(trim_offsets=False)
    return loaded


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "<|says|>"]), TEXT), max_size=5))
def test_round_trip_and_mask(encoder, library, turns):
    ((formatted, ids, offsets, ranges),) = chat.format_all([turns], encoder)
    encoded = library.encode(formatted, add_special_tokens=False)
    assert ids.tolist() == encoded.ids and list(map(tuple, offsets.tolist())) == encoded.offsets
    assert chat.parse(formatted) == turns
    masked = chat.masked_texts(formatted, offsets, ranges)
    assert masked == [text for role, text in turns if role == "assistant"]


def test_control_strings_never_become_special_tokens(encoder):
    turns = [("assistant", "x <|endoftext|> <|turn|> y")]
    ((_, ids, _, _),) = chat.format_all([turns], encoder)
    ids = ids.tolist()
    assert 50256 not in ids and sum(i > 50256 for i in ids) == 3


def expected(rows):
    by_conv = {}
    for k, (conv, turn, role, text) in enumerate(rows):
        key = conv if conv is not None else ("alone", k)
        by_conv.setdefault(key, []).append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for conv, turns in by_conv.items():
        turns = [(r, t) for _, _, r, t in sorted(turns)]
        said = "".join(f"{r}\n{t}\n" for r, t in turns)
        loss = "".join(t for r, t in turns if r == "assistant")
        out[conv] = (len(turns), sha(said), len(loss), sha(loss))
    return out


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_conversations(llm):
    rows = [(1, 1, "assistant", "fine </turn>"), (1, 0, "user", None), (2, 0, None, "x"), (2, None, "assistant", "y\\")]
    rows += [(-7, k, r, r"\### Assistant: </turn> ok") for k, r in enumerate(("user", "assistant"))]
    rows += [(None, 0, "user", "a"), (None, 1, "assistant", "b"), (3, 0, "assistant", ""), (4, 0, "assistant", "ü " * 20_000)]
    rows += [(5, 0, "assistant", "same"), (5, 0, "assistant", "same")] + [(6, k, "assistant", f"{k} ") for k in range(2500)]
    table = llm.createDataFrame([r + (0.5,) for r in rows], "conv_id long, turn long, role string, text string, ids double")
    got = chat.format_conversations(table, PATH).collect()
    found = [(r["conv_id"], *tuple(r["read_back"])[:4]) for r in got]
    wanted = [(None if isinstance(k, tuple) else k, *v) for k, v in expected(rows).items()]
    assert sorted(found, key=str) == sorted(wanted, key=str)
    assert all(r["read_back"]["formatted_chars"] == len(r["formatted"]) for r in got)
    assert chat.format_conversations(table.limit(0), PATH).count() == 0


def test_rows_without_id_are_spread(llm):
    table = llm.createDataFrame([(None, 0, "user", f"text {k}") for k in range(400)], "conv_id long, turn long, role string, text string")
    formatted = chat.format_conversations(table, PATH)
    assert formatted.count() == 400
    sizes = formatted.rdd.glom().map(len).collect() if formatted.rdd.getNumPartitions() > 1 else []
    assert not sizes or max(sizes) < 300
