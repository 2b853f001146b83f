r"""Chat formatting by token-level assembly.

Every text is encoded on its own and reserved ids are spliced around it, so no
text can produce a control id.  In the rendered string the control marks are
plain characters; a mark that occurs inside a text gets one backslash right
before it, and reading back takes that one away.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the public split pattern of this byte-level vocabulary.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

# Fixed values of the template: marks and their reserved ids (the first free id of the vocabulary is 50256).
MARKS = {"system": "### System: ", "user": "### User: ", "assistant": "### Assistant: "}
OTHER_OPEN, OTHER_CLOSE, END = "### Role: ", " ###: ", " </turn>\n"
RESERVED = {mark: 50257 + i for i, mark in enumerate([*MARKS.values(), OTHER_OPEN, OTHER_CLOSE, END])}
TRAINED_ROLE = "assistant"
#: Control strings as they may occur in a text; none overlaps another or holds a backslash.
_CONTROLS = r"(### (?:System|User|Assistant|Role):|###:|</turn>)"
_PLAIN, _ESCAPED = re.compile(_CONTROLS), re.compile(r"\\" + _CONTROLS)


def escape(text: str) -> str:
    r"""Put a backslash right before every control string, whatever stands before it."""
    return _PLAIN.sub(r"\\\1", text)


def unescape(text: str) -> str:
    r"""Take away the one backslash that ``escape`` put before every control string."""
    return _ESCAPED.sub(r"\1", text)


@lru_cache(maxsize=2)
def encoder(path: str = VOCABULARY):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f)}
    return tiktoken.Encoding("chat", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def assemble(role: str, text: str, enc) -> tuple[list[int], list[int], str]:
    """Ids, loss mask and rendered string of one turn.

    The mask is the running sum of +1 where a trained text begins and -1 where it ends.
    """
    body = escape(text)
    mark = MARKS.get(role)
    if mark is not None:
        ids, shown = [RESERVED[mark]], mark
    else:
        name = escape(role)
        ids = [RESERVED[OTHER_OPEN], *enc.encode_ordinary(name), RESERVED[OTHER_CLOSE]]
        shown = OTHER_OPEN + name + OTHER_CLOSE
    first = len(ids)
    ids += enc.encode_ordinary(body)
    step = np.zeros(len(ids) + 2, dtype=np.int8)
    if role == TRAINED_ROLE:
        step[first] += 1
        step[len(ids)] -= 1
    ids.append(RESERVED[END])
    return ids, np.cumsum(step[: len(ids)]).tolist(), shown + body + END


def disassemble(ids: list[int], mask: list[int], enc) -> tuple[str, str, str, str]:
    """Role, text, trained text and rendered string, read from the ids and the mask alone."""
    marks = {v: k for k, v in RESERVED.items()}
    roles = {RESERVED[m]: r for r, m in MARKS.items()}
    decode = lambda part: b"".join(enc.decode_tokens_bytes(part)).decode("utf-8")
    if ids[0] in roles:
        role, at = roles[ids[0]], 1
    else:
        at = ids.index(RESERVED[OTHER_CLOSE])
        role, at = unescape(decode(ids[1:at])), at + 1
    body = decode(ids[at:-1])
    trained = decode([t for t, m in zip(ids, mask, strict=True) if m and t not in marks])
    head = marks[ids[0]] if ids[0] in roles else OTHER_OPEN + escape(role) + OTHER_CLOSE
    return role, unescape(body), unescape(trained), head + body + marks[ids[-1]]


FORMATTED = T.StructType(
    [
        T.StructField("conv_id", T.LongType()),
        T.StructField("turn", T.LongType()),
        T.StructField("token_start", T.LongType(), False),
        T.StructField("ids", T.ArrayType(T.IntegerType(), False), False),
        T.StructField("loss_mask", T.ArrayType(T.ByteType(), False), False),
        T.StructField("rendered", T.StringType(), False),
    ]
)
DIGEST = T.StructType(
    [
        T.StructField("conv_id", T.LongType()),
        T.StructField("n_turns", T.LongType(), False),
        T.StructField("turns_sha256", T.StringType(), False),
        T.StructField("loss_chars", T.LongType(), False),
        T.StructField("loss_sha256", T.StringType(), False),
        T.StructField("formatted_chars", T.LongType(), False),
    ]
)


def _in_order(df: DataFrame, *ties: str) -> DataFrame:
    """Each conversation whole in one task and sorted; Spark spills the sort, and the next step streams it."""
    return df.repartition("conv_id").sortWithinPartitions("conv_id", "turn", *ties)


def format_conversations(turns: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """One row per turn: ids, loss mask, rendered string and the token offset in its conversation.

    Input (conv_id, turn, role, text); other columns are not read.  NULL role or
    text counts as empty, NULL conv_id is a conversation, NULL turns come
    first, and repeated turns stay, ordered by role and text.  A conversation
    streams through its task turn by turn, so its length is not bounded by
    memory.  Rows of a conversation stay together and in order.
    """
    src = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary)
        last, offset = object(), 0
        for b in batches:
            starts, ids, masks, shown = [], [], [], []
            for conv, role, text in zip(*(b.column(i).to_pylist() for i in (0, 2, 3)), strict=True):
                if conv != last:
                    last, offset = conv, 0
                i, m, s = assemble(role, text, enc)
                starts.append(offset)
                ids.append(i)
                masks.append(m)
                shown.append(s)
                offset += len(i)
            made = [pa.array(starts, pa.int64()), pa.array(ids, pa.list_(pa.int32())), pa.array(masks, pa.list_(pa.int8())), pa.array(shown, pa.string())]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *made], names=FORMATTED.names)

    return _in_order(src, "role", "text").mapInArrow(work, FORMATTED)


def read_back(formatted: DataFrame, in_order: bool = False, vocabulary: str = VOCABULARY) -> DataFrame:
    """Digest of every conversation, decoded from ids and loss masks.

    ``in_order`` tells that rows come straight from ``format_conversations``;
    otherwise they are sorted by token offset first.
    """
    src = formatted.select("conv_id", "token_start", "ids", "loss_mask")
    if not in_order:
        src = src.repartition("conv_id").sortWithinPartitions("conv_id", "token_start")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary)
        last, acc, done = object(), None, []

        def close():
            done.append((last, acc[0], acc[1].hexdigest(), acc[2], acc[3].hexdigest(), acc[4]))

        for b in batches:
            for conv, ids, mask in zip(*(b.column(i).to_pylist() for i in (0, 2, 3)), strict=True):
                if conv != last or acc is None:
                    if acc is not None:
                        close()
                    last, acc = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                role, text, trained, shown = disassemble(ids, mask, enc)
                acc[0] += 1
                acc[1].update(f"{role}\n{text}\n".encode())
                acc[2] += len(trained)
                acc[3].update(trained.encode())
                acc[4] += len(shown)
            if done:
                yield pa.RecordBatch.from_pylist([dict(zip(DIGEST.names, d, strict=True)) for d in done], schema=_arrow(DIGEST))
                done.clear()
        if acc is not None:
            close()
            yield pa.RecordBatch.from_pylist([dict(zip(DIGEST.names, d, strict=True)) for d in done], schema=_arrow(DIGEST))

    return src.mapInArrow(work, DIGEST)


def _arrow(schema: T.StructType) -> pa.Schema:
    kinds = {T.LongType(): pa.int64(), T.StringType(): pa.string()}
    return pa.schema([(f.name, kinds[f.dataType]) for f in schema.fields])


#: Conversation of the contract whose texts hold control strings.
PROBE = r"\### Assistant: </turn> ok"


def chat_table(conversations: DataFrame) -> DataFrame:
    """Digest of every conversation and of conversation -7."""
    spark = conversations.sparkSession
    probe = spark.createDataFrame([(-7, 0, "user", PROBE), (-7, 1, "assistant", PROBE)], "conv_id long, turn long, role string, text string")
    turns = conversations.select("conv_id", "turn", "role", "text").unionByName(probe)
    return read_back(format_conversations(turns), in_order=True)


_REPL = r"\\\1"
CHAT_SQL = f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '{PROBE}' UNION ALL SELECT -7, 1, 'assistant', '{PROBE}'),
e AS (SELECT *, regexp_replace(text, '{_CONTROLS}', '{_REPL}', 'g') AS body, regexp_replace(role, '{_CONTROLS}', '{_REPL}', 'g') AS name FROM t)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length(body) + {len(END)} + CASE role {' '.join(f"WHEN '{r}' THEN {len(m)}" for r, m in MARKS.items())}
            ELSE {len(OTHER_OPEN) + len(OTHER_CLOSE)} + length(name) END) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""
