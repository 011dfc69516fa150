"""Chat formatting at token level: segments are encoded apart, reserved ids are spliced in, masks come from prefix sums.

A reserved id stands for a control string. Content can never give one, since it is encoded as ordinary text; so that the
written form is safe too, a control string inside content gets a backslash after its first character (and one more where
it has some already), which reading takes out again.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_rows, utf8

#: Control strings in the order of their reserved ids, which follow the vocabulary's.
CONTROLS = ["<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|role|>", "<|text|>", "<|end|>"]
BOS, EOS, INST, INST_END, SYS, SYS_END, ROLE, TEXT, END = range(len(CONTROLS))
#: (control strings before the text, after it) of the roles that have marks of their own.
MARKS = {"user": ([INST], [INST_END]), "system": ([SYS], [SYS_END]), "assistant": ([], [EOS])}
ESCAPABLE = re.compile("|".join(rf"{re.escape(c[0])}(?=\\*{re.escape(c[1:])})" for c in CONTROLS))
ESCAPED = re.compile("|".join(rf"{re.escape(c[0])}\\(?=\\*{re.escape(c[1:])})" for c in CONTROLS))
TURNS = "conv_id long, turn long, role string, text string, ids array<int>, loss array<boolean>"
CHECKED = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, "
    "n_tokens long, n_loss_tokens long"
)


def escape(text: str) -> str:
    return ESCAPABLE.sub(lambda m: m[0] + "\\", text)


def unescape(text: str) -> str:
    return ESCAPED.sub(lambda m: m[0][0], text)


def _segments(role: str, text: str) -> list[tuple[int | str, bool]]:
    """Reserved numbers and content of a turn, each with whether the loss counts it."""
    if role in MARKS:
        before, after = MARKS[role]
        head = [(c, False) for c in before]
    else:
        head, after = [(ROLE, False), (escape(role), False), (TEXT, False)], [END]
    return [*head, (escape(text), role == "assistant"), *((c, False) for c in after)]


def format_turns(turns: DataFrame, vocabulary: Broadcast) -> DataFrame:
    """Every turn with its ids and its loss mask; the ids of a conversation are BOS and then those of its turns.

    The mask covers the text of assistant turns alone. A null text or role is empty; a role without marks of its own is
    written out. Null conversation ids form one conversation. Further columns are left out.
    """

    def work(batch: pa.RecordBatch):
        conv, turn, roles, texts = (batch.column(i).to_pylist() for i in range(4))
        vocab = vocabulary.value
        base = len(vocab.tokens)
        ids, masks = [], []
        for role, text in zip(roles, texts):
            parts, steps = [], []
            for segment, counts in _segments(role, text):
                part = (
                    np.array([base + segment], np.int32)
                    if isinstance(segment, int)
                    else np.frombuffer(vocab.encode(segment), "<i4")
                )
                parts.append(part)
                steps.append((len(part), counts))
            lengths = np.array([n for n, _ in steps])
            ends = np.cumsum(lengths)
            edges = np.zeros(int(ends[-1]) + 1, np.int64)
            for (n, counts), end in zip(steps, ends.tolist()):
                if counts:
                    edges[end - n] += 1
                    edges[end] -= 1
            ids.append(np.concatenate(parts))
            masks.append(np.cumsum(edges[:-1]) > 0)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(conv, pa.int64()), pa.array(turn, pa.int64()), pa.array(roles, pa.string()),
                pa.array(texts, pa.string()), pa.array(ids, pa.list_(pa.int32())), pa.array(masks, pa.list_(pa.bool_())),
            ],
            names=[c.split()[0] for c in TURNS.split(", ")],
        )

    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    return map_rows(rows, work, TURNS)


def _content(ids: np.ndarray, tokens: list[bytes]) -> str:
    return b"".join(map(tokens.__getitem__, ids.tolist())).decode("utf-8")


def read_turn(ids: np.ndarray, loss: np.ndarray, tokens: list[bytes]) -> tuple[str, str, str, int]:
    """(role, text, text under the mask, written characters) of the ids of one turn."""
    base = len(tokens)
    marks = np.flatnonzero(ids >= base)
    controls = (ids[marks] - base).tolist()
    written = sum(len(CONTROLS[c]) for c in controls)
    if controls[0] == ROLE:
        raw_role = _content(ids[marks[0] + 1 : marks[1]], tokens)
        raw = _content(ids[marks[1] + 1 : marks[2]], tokens)
        role = unescape(raw_role)
        written += len(raw_role)
    else:
        role = {INST: "user", SYS: "system", EOS: "assistant"}[controls[0]]
        start = 0 if role == "assistant" else 1
        raw = _content(ids[start : marks[-1]], tokens)
    counted = ids[loss]
    return role, unescape(raw), unescape(_content(counted[counted < base], tokens)), written + len(raw)


def read_conversations(formatted: DataFrame, vocabulary: Broadcast) -> DataFrame:
    """One row per conversation, read back from its ids and masks.

    Turns come in order of (turn, role, text). They pass through a task one by one, so that memory does not grow with a
    conversation; what is kept of it are running digests.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = vocabulary.value.tokens
        names = [c.split()[0] for c in CHECKED.split(", ")]
        key, state, done = None, None, []

        def finish() -> tuple:
            return (
                key, state["turns"], state["all"].hexdigest(), state["loss_chars"], state["loss"].hexdigest(),
                state["chars"], state["tokens"], state["loss_tokens"],
            )

        def flush() -> pa.RecordBatch:
            schema = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*done), schema)], names=names)

        for batch in batches:
            convs = batch.column(0).to_pylist()
            for i, conv in enumerate(convs):
                if state is None or conv != key:
                    if state is not None:
                        done.append(finish())
                    key = conv
                    state = dict(
                        turns=0, all=hashlib.sha256(), loss=hashlib.sha256(), loss_chars=0,
                        chars=len(CONTROLS[BOS]), tokens=1, loss_tokens=0,
                    )
                ids = batch.column(1)[i].values.to_numpy(zero_copy_only=False)
                mask = batch.column(2)[i].values.to_numpy(zero_copy_only=False)
                role, text, learnt, written = read_turn(ids, mask, tokens)
                state["turns"] += 1
                state["all"].update(utf8(f"{role}\n{text}\n"))
                state["loss"].update(utf8(learnt))
                state["loss_chars"] += len(learnt)
                state["chars"] += written
                state["tokens"] += len(ids)
                state["loss_tokens"] += int(mask.sum())
            if len(done) >= 1000:
                yield flush()
                done.clear()
        if state is not None:
            done.append(finish())
        if done:
            yield flush()

    ordered = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.select("conv_id", "ids", "loss").mapInArrow(run, CHECKED)


def assemble(formatted: DataFrame, bos: int) -> DataFrame:
    """(conv_id, ids, loss) of whole conversations, BOS first: what training reads."""
    turns = F.array_sort(F.collect_list(F.struct("turn", "role", "text", "ids", "loss")))
    return formatted.groupBy("conv_id").agg(turns.alias("t")).select(
        "conv_id",
        F.concat(F.array(F.lit(bos)), F.flatten("t.ids")).alias("ids"),
        F.concat(F.array(F.lit(False)), F.flatten("t.loss")).alias("loss"),
    )
