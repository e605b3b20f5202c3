"""Token counts of whole texts with a public tokenizer, by batch encoding in an Arrow function."""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.storage import clear_of
from plumbline.llm.words import slabs

# The characters that the tokenizer's pattern takes as white space.
SPACE = "\t-\r \x85\xa0  -     　"
PIECE = re.compile(f"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+")
CALL_BYTES = 256 << 10  # of text in one call of the encoder
LONG = 1 << 20  # characters of a text looked at together
KNOWN = 400_000  # pieces a worker remembers the length of


class Lengths:
    """Token counts through pieces cut where a space run follows other characters.

    No token spans such a place, whatever stands on either side: the tokenizer's pattern never puts
    white space after another character into one unit, and its special strings hold no white space. So the
    counts of the pieces add up to the text's. Pieces recur, and each is encoded once while it is remembered.
    """

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.known: dict[str, int] = {}

    def learn(self, pieces) -> None:
        """Encodes pieces not remembered, in calls of about equal bytes."""
        call, size = [], 0
        for piece in sorted(pieces, key=len):
            call.append(piece)
            size += len(piece.encode())
            if size >= CALL_BYTES:
                self.encode(call)
                call, size = [], 0
        self.encode(call)

    def encode(self, call: list[str]) -> None:
        if call:
            found = self.tokenizer.encode_batch_fast(call, add_special_tokens=False)
            self.known.update(zip(call, map(len, found), strict=True))

    @staticmethod
    def stretches(text: str):
        """Parts of a long text that end where a piece does."""
        at = 0
        while at < len(text):
            end = at + LONG
            if end < len(text):
                step = re.compile(f"(?<=[^{SPACE}])[{SPACE}]").search(text, end)
                end = step.start() if step else len(text)
            yield text[at:end]
            at = end

    def count(self, texts: list[str]) -> list[int]:
        out = []
        pieces = [[PIECE.findall(part) for part in self.stretches(text)] for text in texts]
        wanted = {p for parts in pieces for part in parts for p in part}
        if len(self.known) + len(wanted) > KNOWN:
            self.known = {p: self.known[p] for p in wanted if p in self.known}
        self.learn(wanted.difference(self.known))
        length = self.known.__getitem__
        for parts in pieces:
            out.append(sum(sum(map(length, part)) for part in parts))
        return out


def _counted(path: str, text: str):
    def run(batches):
        lengths = Lengths(path)
        for batch in batches:
            found: list[int] = []
            for _, part in slabs(batch, text, 2 << 20):  # batches balanced by bytes
                found += lengths.count([t or "" for t in part.column(text).to_pylist()])
            kept = batch.drop_columns([text])
            yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(found, pa.int64())], [*kept.schema.names, "n_tokens"])
    return run


def token_counts(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", limit: int = 512) -> DataFrame:
    """``key``, ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit`` of every row's whole text.

    ``tokenizer`` is the path of a tokenizers file that every executor can read. No begin, end or added special tokens,
    truncation or padding; special strings inside a text count as the library's default has them. Null and empty
    texts have 0 of both. A text without white space is encoded in one piece. Repeated rows and null keys come
    out as they are; other columns are not read. Rows stay in their partitions: nothing is shuffled.
    """
    k, n = clear_of(docs.select(text), "key", "n_bytes")
    plain = docs.select(F.col(key).alias(k), F.octet_length(F.coalesce(F.col(text), F.lit(""))).cast("long").alias(n), F.col(text))
    kind = plain.schema[k].dataType.simpleString()
    found = plain.mapInArrow(_counted(tokenizer, text), f"{k} {kind}, {n} long, n_tokens long")
    return found.select(F.col(k).alias(key), F.col(n).alias("n_bytes"), "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
