"""Chat formatting with offset-aligned loss masks.

A conversation is rendered to one text with control strings around its turns. Control strings inside a text or role get a
backslash after their first character (one more where there are some), which reading back removes. The text is
encoded once, with the tokens' offsets; the spans of the assistant's texts, sorted like the tokens, are found among the
token spans by binary search, and the tokens they touch are under the loss mask.
"""

from __future__ import annotations

import os
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.json"
CONTROL = ["<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "[ROLE]", "[/ROLE]", "[END]"]
BODY = "|".join(re.escape(c[1:]) for c in CONTROL)
ESCAPE, UNESCAPE = re.compile(rf"([<\[])(\\*)(?={BODY})"), re.compile(rf"([<\[])\\(\\*)(?={BODY})")
FORMS = {"system": ("<<SYS>>\n", "\n<</SYS>>"), "user": ("[INST] ", " [/INST]"), "assistant": ("<s> ", " </s>")}
TURN = re.compile(r"<<SYS>>\n(?P<system>.*?)\n<</SYS>>|\[INST\] (?P<user>.*?) \[/INST\]|<s> (?P<assistant>.*?) </s>|\[ROLE\](?P<role>.*?)\[/ROLE\] (?P<other>.*?) \[END\]", re.S)
BLOCK_CHARS = 1 << 20
BLOCK_TYPE = "conv_id long, block int, formatted string, token_ids array<int>, loss_mask array<boolean>, loss_spans array<int>"


def escape(text: str) -> str:
    return ESCAPE.sub(r"\1\\\2", text)


def unescape(text: str) -> str:
    return UNESCAPE.sub(r"\1\2", text)


def render(turns: list[tuple[str, str]], loss_role: str = "assistant") -> tuple[str, list[tuple[int, int]]]:
    """The turns' text, and where the texts of `loss_role` lie in it."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        before, after = FORMS.get(role) or (f"[ROLE]{escape(role)}[/ROLE] ", " [END]")
        inner = escape(text)
        if role == loss_role:
            spans.append((at + len(before), at + len(before) + len(inner)))
        parts += [before, inner, after]
        at += len(before) + len(inner) + len(after)
    return "".join(parts), spans


def read_back(formatted: str) -> list[tuple[str, str]]:
    """The turns that `render` made the text from."""
    out = []
    for m in TURN.finditer(formatted):
        kind = m.lastgroup
        out.append((unescape(m["role"]), unescape(m["other"])) if kind == "other" else (kind, unescape(m[kind])))
    return out


def loss_tokens(starts: np.ndarray, ends: np.ndarray, spans: list[tuple[int, int]]) -> tuple[np.ndarray, list[int]]:
    """Which tokens (sorted spans) touch one of the sorted `spans`, and the stretches of text they share with it."""
    mask, shared = np.zeros(len(starts), bool), []
    for a, b in spans:
        i, j = int(np.searchsorted(ends, a, "right")), int(np.searchsorted(starts, b, "left"))
        if a < b and i < j:
            mask[i:j] = True
            shared += [max(a, int(starts[i])), min(b, int(ends[j - 1]))]
    return mask, shared


def _blocks(path: str, loss_role: str, limit: int):
    def run(batches):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import AddedToken, Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.add_special_tokens([AddedToken(c, special=True) for c in CONTROL])

        def made(conv, block, turns):
            text, spans = render(turns, loss_role)
            encoded = tokenizer.encode(text, add_special_tokens=False)
            offsets = np.array(encoded.offsets, np.int64).reshape(-1, 2)
            # tokens inside one character all span it, so both bounds never fall
            mask, shared = loss_tokens(offsets[:, 0], offsets[:, 1], spans)
            return pa.RecordBatch.from_arrays([pa.array([conv], pa.int64()), pa.array([block], pa.int32()), pa.array([text]), pa.array([encoded.ids], pa.list_(pa.int32())), pa.array([mask], pa.list_(pa.bool_())), pa.array([shared], pa.list_(pa.int32()))], ["conv_id", "block", "formatted", "token_ids", "loss_mask", "loss_spans"])

        now, block, turns, held = None, -1, [], 0
        for batch in batches:
            for conv, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text")), strict=True):
                fresh = block < 0 or conv != now
                if turns and (fresh or held + len(text) > limit):
                    yield made(now, block, turns)
                    block, turns, held = block + 1, [], 0
                if fresh:
                    now, block = conv, 0
                turns.append((role, text))
                held += len(text)
        if turns:
            yield made(now, block, turns)

    return run


def format_chats(conversations: DataFrame, *, tokenizer: str = TOKENIZER, loss_role: str = "assistant", conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The conversations rendered and encoded: conv_id, block, formatted, token_ids, loss_mask, loss_spans.

    Turns are in order of turn (null first), then role and text; repeated rows all stay. Null text and null role are
    empty; roles other than system, user and assistant are written out. Rows with a null conv_id are one conversation.
    loss_spans holds begin and end, in code points of `formatted`, of each non-empty text under the mask. An empty table
    gives no rows; other columns are not looked at.

    A conversation is one row, unless it is longer than `block_chars`: then it is several, cut between turns. The
    control strings are tokens of their own, at which the tokenizer cuts first, so the blocks' tokens are those of the
    whole. The rows come out in order of conversation and block within their partition; turns stream through a task
    one block at a time, so a conversation of any length fits.
    """
    rows = conversations.select(F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).alias("turn"), F.coalesce(role_col, F.lit("")).alias("role"), F.coalesce(text_col, F.lit("")).alias("text"))
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "role", "text").mapInArrow(_blocks(tokenizer, loss_role, block_chars), BLOCK_TYPE)


DIGEST_TYPE = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def digests(blocks: DataFrame) -> DataFrame:
    """One row per conversation of `format_chats`, in whose order its blocks must still be, all read back from the output.

    n_turns and turns_sha256 (of role, \\n, text, \\n per turn) from the formatted text, loss_chars and loss_sha256 from the
    text under the mask, formatted_chars.
    """

    def run(batches):
        import hashlib

        now = None

        def row():
            conv, n, turns, chars, loss, length = now
            return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in ((conv, pa.int64()), (n, pa.int64()), (turns.hexdigest(), pa.string()), (chars, pa.int64()), (loss.hexdigest(), pa.string()), (length, pa.int64()))], ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

        for batch in batches:
            for i in range(batch.num_rows):
                conv, block, text, spans = (batch.column(c)[i].as_py() for c in ("conv_id", "block", "formatted", "loss_spans"))
                if block == 0:
                    if now:
                        yield row()
                    now = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, said in read_back(text):
                    now[1] += 1
                    now[2].update(f"{role}\n{said}\n".encode("utf-8", "surrogatepass"))
                for a, b in zip(spans[::2], spans[1::2], strict=True):
                    said = unescape(text[a:b])
                    now[3] += len(said)
                    now[4].update(said.encode("utf-8", "surrogatepass"))
                now[5] += len(text)
        if now:
            yield row()

    return blocks.select("conv_id", "block", "formatted", "loss_spans").mapInArrow(run, DIGEST_TYPE)
