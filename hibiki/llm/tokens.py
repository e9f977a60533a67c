"""Sizes of texts in tokens of a public tokenizer."""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rank file of a byte-level BPE; any such file may be named instead.
TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the pre-tokenizer pattern that such vocabularies are made with.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


#: Largest rank file that is sent out with a job.
MOST_BYTES = 32 << 20
_made: dict[int, object] = {}


def encoding(ranks: bytes):
    """The tokenizer of a rank file's content; made once a process."""
    key = zlib.crc32(ranks)
    if key not in _made:
        import tiktoken

        pairs = (line.split() for line in ranks.splitlines() if line)
        _made[key] = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks={base64.b64decode(a): int(b) for a, b in pairs}, special_tokens={})
    return _made[key]


def with_tokens(df: DataFrame, keys: list[str], text: str, tokenizer: str = TOKENIZER, out: str = "tokens") -> DataFrame:
    """keys + tokens bigint: the whole text's size; 0 for a null or empty text.

    The rank file is read where the job is started and sent out with it, so executors need no copy.
    """
    with open(tokenizer, "rb") as f:
        ranks = f.read(MOST_BYTES + 1)
    if len(ranks) > MOST_BYTES:
        raise ValueError(f"{tokenizer} is larger than {MOST_BYTES} bytes")
    sent = df.sparkSession.sparkContext.broadcast(ranks)
    schema = df.select(*keys).schema.add(out, "long")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(sent.value)
        for b in batches:
            sizes = [len(enc.encode_ordinary(t)) if t else 0 for t in b.column(b.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(sizes, pa.int64())], [*keys, out])

    return df.select(*keys, F.col(text).alias("_text")).mapInArrow(count, schema)
