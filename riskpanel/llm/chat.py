"""Chat formatting with loss masks aligned to token offsets.

A conversation is rendered whole, each turn between control strings, and encoded
once with character offsets. The sorted spans of the assistant's texts meet the
sorted spans of the tokens by binary search: the mask holds the tokens that
reach into a span, each with the part of it that lies inside.

Control strings inside roles and texts are escaped by a backslash behind their first
letter (one more if there are some already), so that no text can open or close
a turn, and ``unescaped`` gives the text back. A line break or backslash in a
role is written with a backslash too.

Defined results: a null text or role is empty; a conversation's rows come in order
of turn (null first), role and text, repeated rows each as a turn; rows with a
null conv_id are one conversation; a conversation without assistant has an empty
mask; an empty table gives only the conversations asked for besides; other columns
play no part, whatever their names. One conversation has to fit in a task's memory.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from riskpanel.llm import texts

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
CONTROLS = [OPEN, CLOSE, "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>",
            "<</SYS>>"]
ASSISTANT = "assistant"
VOCABULARY = "byte_bpe_50k.json"
SHARE = 64  # conversations encoded at once


def _controls(marks: str) -> re.Pattern:
    return re.compile("|".join(re.escape(c[0]) + marks + re.escape(c[1:]) for c in CONTROLS))


TO_ESCAPE, ESCAPED = _controls(r"\\*"), _controls(r"\\+")


def escaped(text: str) -> str:
    return TO_ESCAPE.sub(lambda m: m[0][0] + "\\" + m[0][1:], text)


def unescaped(text: str) -> str:
    return ESCAPED.sub(lambda m: m[0][0] + m[0][2:], text)


def role_line(role: str) -> str:
    return escaped(role.replace("\\", "\\\\").replace("\n", "\\n"))


def role_of(line: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescaped(line), flags=re.S)


def rendered(turns: list[tuple[str, str]]) -> tuple[str, np.ndarray]:
    """The formatted conversation and the spans of the assistant's texts in it."""
    out, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"{OPEN}{role_line(role)}\n", escaped(text)
        out += [head, body, CLOSE, "\n"]
        if role == ASSISTANT:
            spans.append((at + len(head), at + len(head) + len(body)))
        at += len(head) + len(body) + len(CLOSE) + 1
    return "".join(out), np.array(spans, np.int64).reshape(-1, 2)


def read_back(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted conversation."""
    out = []
    for piece in formatted.split(OPEN)[1:]:
        line, _, body = piece.partition("\n")
        out.append((role_of(line), unescaped(body[:-len(CLOSE) - 1])))
    return out


def masked(tokens: np.ndarray, spans: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which tokens are under the mask, and the character ranges of it that they cover.

    Tokens that share a character (parts of its bytes) are all under the mask; the
    character is covered by the first of them.
    """
    mask = np.zeros(len(tokens), bool)
    pieces = []
    begins, ends = tokens[:, 0], np.maximum.accumulate(tokens[:, 1]) if len(tokens) else tokens[:, 1]
    for a, b in spans[spans[:, 1] > spans[:, 0]].tolist():
        low = int(np.searchsorted(ends, a, "right"))
        high = int(np.searchsorted(begins, b, "left"))
        mask[low:high] = True
        begin = np.maximum(begins[low:high], a)
        end = np.minimum(ends[low:high], b)
        begin[1:] = np.maximum(begin[1:], end[:-1])
        pieces.append(np.stack([begin, end], 1)[end > begin])
    return mask, np.concatenate(pieces) if pieces else np.zeros((0, 2), np.int64)


def tokenizer(file: str):
    """The public tokenizer; its offsets keep the white space, its control strings are text."""
    from tokenizers import Tokenizer, processors

    out = Tokenizer.from_str(file)
    out.no_truncation()
    out.no_padding()
    out.encode_special_tokens = True
    out.post_processor = processors.ByteLevel(trim_offsets=False)
    return out


def conversations_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, list]]:
    """Sorted rows as conversations."""
    now, turns = None, []
    for batch in batches:
        rows = zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text")))
        for conv, role, text in rows:
            if turns and conv != now:
                yield now, turns
                turns = []
            now = conv
            turns.append((role or "", text or ""))
    if turns:
        yield now, turns


def formatted(conversations: DataFrame, path: str | None = None) -> DataFrame:
    """Per conversation: conv_id, formatted, tokens (ids), mask (per token) and the mask's
    character ranges as ``loss_starts`` and ``loss_ends``."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(VOCABULARY)
    spark = conversations.sparkSession
    texts.workers_find_package(spark)
    with open(path, encoding="utf-8") as f:
        shared = spark.sparkContext.broadcast(f.read())  # a few MB, whatever the input

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokenizer(shared.value)
        some = []
        for item in conversations_of(batches):
            some.append(item)
            if len(some) == SHARE:
                yield _batch(some, encoder, key)
                some = []
        if some:
            yield _batch(some, encoder, key)

    kind = conversations.schema["conv_id"].dataType.simpleString()
    key = to_arrow_type(conversations.schema["conv_id"].dataType)
    return (conversations.select("conv_id", "turn", "role", "text")
            .repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
            .mapInArrow(run, f"conv_id {kind}, formatted string, tokens array<int>, "
                             "mask array<boolean>, loss_starts array<int>, loss_ends array<int>"))


def _batch(some: list, encoder, key: pa.DataType) -> pa.RecordBatch:
    made = [rendered(turns) for _, turns in some]
    out = []
    for (text, spans), code in zip(made, encoder.encode_batch([t for t, _ in made],
                                                             add_special_tokens=False)):
        tokens = np.array(code.offsets, np.int64).reshape(-1, 2)
        mask, pieces = masked(tokens, spans)
        out.append((text, code.ids, mask, pieces[:, 0], pieces[:, 1]))
    text, numbers, mask, starts, ends = zip(*out)
    return pa.RecordBatch.from_arrays(
        [pa.array([c for c, _ in some], key), pa.array(text, pa.string()),
         pa.array(numbers, pa.list_(pa.int32())), pa.array(mask, pa.list_(pa.bool_())),
         pa.array(starts, pa.list_(pa.int32())), pa.array(ends, pa.list_(pa.int32()))],
        names=["conv_id", "formatted", "tokens", "mask", "loss_starts", "loss_ends"])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for text, starts, ends in zip(*(batch.column(c).to_pylist()
                                        for c in ("formatted", "loss_starts", "loss_ends"))):
            turns = read_back(text)
            said = "".join(f"{role}\n{body}\n" for role, body in turns)
            # joined by texts, so that a control string's escape is undone where it stands
            loss = _under(text, starts, ends)
            out.append((len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss),
                        hashlib.sha256(loss.encode()).hexdigest(), len(text)))
        n, said, chars, loss, size = zip(*out) if out else ((),) * 5
        yield pa.RecordBatch.from_arrays(
            [batch.column("conv_id"), pa.array(n, pa.int64()), pa.array(said, pa.string()),
             pa.array(chars, pa.int64()), pa.array(loss, pa.string()),
             pa.array(size, pa.int64())],
            names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256",
                   "formatted_chars"])


def _under(text: str, starts: list[int], ends: list[int]) -> str:
    """The text under the mask; adjoining ranges are one before their escapes are undone."""
    out, begin, last = [], None, None
    for a, b in zip(starts, ends):
        if a != last:
            if begin is not None:
                out.append(unescaped(text[begin:last]))
            begin = a
        last = b
    if begin is not None:
        out.append(unescaped(text[begin:last]))
    return "".join(out)


def report(conversations: DataFrame, path: str | None = None) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256 and formatted_chars, all read
    back from the formatted text and its mask."""
    kind = conversations.schema["conv_id"].dataType.simpleString()
    return formatted(conversations, path).select(
        "conv_id", "formatted", "loss_starts", "loss_ends").mapInArrow(
        _digests, f"conv_id {kind}, n_turns bigint, turns_sha256 string, loss_chars bigint, "
                  "loss_sha256 string, formatted_chars bigint")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one, -7, whose texts are control strings."""
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        "role", "text")
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, ASSISTANT, said)],
                                  "conv_id long, turn long, role string, text string")
    return report(rows.unionByName(extra))


def report_sql() -> str:
    """DuckDB SQL for ``query``. A role of this table has no control string in it."""
    one = "|".join(re.escape(c[0]) + r"\\*" + re.escape(c[1:]) for c in CONTROLS)
    one = one.replace("'", "''")
    return f"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS t FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || t || chr(10), '' ORDER BY turn, role, t)) AS turns_sha256,
  coalesce(sum(length(t)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(t, '' ORDER BY turn, role, t) FILTER (role = 'assistant'), ''))
    AS loss_sha256,
  sum({len(OPEN) + len(CLOSE) + 2} + length(role) + length(t)
      + len(regexp_extract_all(t, '{one}')))::BIGINT AS formatted_chars
FROM c GROUP BY conv_id
"""
