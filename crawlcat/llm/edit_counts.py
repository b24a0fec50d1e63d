"""Edit-aware token counts.

Each document keeps a segment tree: leaves are runs of whole pre-tokens of
about LEAF characters, cut before a space or newline (where no merge of the
vocabulary reaches across), and inner nodes hold the sums of FAN children.
``build`` encodes every document once and stores the leaves' characters and
tokens beside the text, which is what a tree has to remember: the sums above
follow from them without the vocabulary.  ``update`` takes such rows and edits:
an edit re-encodes the leaves it touches and the one before, whose last
pre-token it may lengthen, and updates the sums above them; all else stays, and
the trees come out again for the next edits.

Narrow: documents and their edits come in one row.  The edits of a slice are
applied in rounds, the n-th of every document together, with one call of the
encoder a round.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from crawlcat.llm.common import released
from crawlcat.llm.wordids import encoder, slices, vocabulary_path

LEAF, FAN = 512, 16

COUNTS = ["doc_id", "n_tokens", "n_edits", "n_tokens_edited", "n_chars_edited", "reencoded_chars", "n_leaves"]
TREES = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("leaf_chars", T.ArrayType(T.IntegerType())),
        T.StructField("leaf_tokens", T.ArrayType(T.IntegerType())),
    ]
)
UPDATED = T.StructType([*TREES.fields, *(T.StructField(n, T.LongType()) for n in COUNTS[1:])])
_ARROW = [pa.int64(), pa.string(), pa.list_(pa.int32()), pa.list_(pa.int32())]


def cut(text: str, size: int = LEAF) -> list[str]:
    """Leaves of a text: each but the first begins with a space or newline."""
    out, at = [], 0
    while len(text) - at > size:
        end = max(text.rfind(" ", at + 1, at + size), text.rfind("\n", at + 1, at + size))
        if end < 0:
            found = [p for p in (text.find(" ", at + size), text.find("\n", at + size)) if p >= 0]
            if not found:
                break
            end = min(found)
        out.append(text[at:end])
        at = end
    out.append(text[at:])
    return out


class Tree:
    """Sums of characters and tokens over the leaves of one document, and its text."""

    def __init__(self, text: str, chars, tokens):
        self.text = text
        self._sum(np.stack([np.asarray(chars, np.int64), np.asarray(tokens, np.int64)], axis=1))

    def _sum(self, leaves: np.ndarray) -> None:
        self.levels = [leaves]
        while len(self.levels[-1]) > 1:
            self.levels.append(np.add.reduceat(self.levels[-1], np.arange(0, len(self.levels[-1]), FAN), axis=0))

    @property
    def tokens(self) -> int:
        return int(self.levels[-1][0, 1])

    def find(self, char: int) -> tuple[int, int]:
        """The leaf that holds a character, by descent, and where the leaf begins."""
        node, begin = 0, 0
        for level in reversed(self.levels[:-1]):
            node *= FAN
            while node + 1 < len(level) and char >= begin + level[node, 0]:
                begin += int(level[node, 0])
                node += 1
        return node, begin

    def splice(self, start: int, end: int, text: str) -> tuple[int, int, list[str]]:
        """Replace characters ``start`` to ``end`` of the text; (first, last) of the leaves that it touches and what takes their place.

        Bounds are brought into the text.  ``settle`` has to follow.
        """
        start = min(max(0, start), len(self.text))
        end = min(max(start, end), len(self.text))
        first, begin = self.find(max(0, start - 1))
        last, last_begin = self.find(max(0, start - 1, end - 1))
        stop = last_begin + int(self.levels[0][last, 0])
        region = self.text[begin:start] + text + self.text[end:stop]
        self.text = self.text[:begin] + region + self.text[stop:]
        return first, last, cut(region) if len(region) > 2 * LEAF else [region]

    def settle(self, first: int, last: int, leaves: list[str], tokens: list[int]) -> None:
        """Put leaves in the place of others and update the sums above them."""
        new = np.array([[len(s), n] for s, n in zip(leaves, tokens)], np.int64)
        if len(new) > last - first + 1:
            self._sum(np.concatenate([self.levels[0][:first], new, self.levels[0][last + 1 :]]))
            return
        for k in range(first, last + 1):
            change = (new[k - first] if k - first < len(new) else 0) - self.levels[0][k]
            leaf = k
            for level in self.levels:
                level[leaf] += change
                leaf //= FAN


def _sizes(enc, leaves: list[str]) -> list[int]:
    return np.diff(enc.encode(pa.array(leaves, pa.string()))[1]).tolist()


def build(docs: DataFrame, *keep: str, vocabulary: str | None = None) -> DataFrame:
    """TREES rows of ``docs`` (``doc_id``, ``text`` and the columns in ``keep``; others are ignored), to be stored.

    A null text counts as empty, which is one empty leaf.  Repeated rows have a
    tree each; an empty table gives no rows.
    """
    vocabulary = vocabulary or vocabulary_path()

    def built(batches):
        enc = encoder(vocabulary)
        for batch in batches:
            for a, b in slices(batch.column(1)):
                leaves = [cut(t) for t in batch.column(1).slice(a, b - a).to_pylist()]
                flat = _sizes(enc, [s for own in leaves for s in own])
                ends = np.cumsum([0, *map(len, leaves)]).tolist()
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), pa.array([[len(s) for s in own] for own in leaves], _ARROW[2]), pa.array([flat[x:y] for x, y in zip(ends, ends[1:])], _ARROW[3]), *(c.slice(a, b - a) for c in batch.columns[2:])], [*TREES.names, *keep])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), *keep)
    return rows.mapInArrow(released(built), T.StructType([*TREES.fields, *(docs.schema[k] for k in keep)]))


def update(trees: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """UPDATED rows of stored trees (TREES) and ``edits``, an array of (start, end, text) applied in order.

    Positions are characters of the text as the edits before have left it.
    Null edits count as none, a null replacement as a deletion; positions
    beyond the text as its end.  No document is encoded again as a whole.
    Repeated rows are answered each; an empty table gives no rows.
    """
    vocabulary = vocabulary or vocabulary_path()

    def updated(batches):
        enc = encoder(vocabulary)
        for batch in batches:
            for a, b in slices(batch.column(1)):
                ids, texts, chars, tokens, edits = (batch.column(i).slice(a, b - a).to_pylist() for i in range(5))
                own = [Tree(*x) for x in zip(texts, chars, tokens)]
                before, again = [t.tokens for t in own], [0] * len(own)
                for k in range(max((len(e) for e in edits), default=0)):
                    asked = [(i, own[i].splice(e[k]["start"] or 0, e[k]["end"] or 0, e[k]["text"] or "")) for i, e in enumerate(edits) if len(e) > k]
                    flat, at = _sizes(enc, [s for _, (_, _, leaves) in asked for s in leaves]), 0
                    for i, (first, last, leaves) in asked:
                        own[i].settle(first, last, leaves, flat[at : at + len(leaves)])
                        at += len(leaves)
                        again[i] += sum(map(len, leaves))
                leaf = [t.levels[0] for t in own]
                counted = [before, [len(e) for e in edits], [t.tokens for t in own], [len(t.text) for t in own], again, [len(x) for x in leaf]]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(([ids, [t.text for t in own], [x[:, 0].tolist() for x in leaf], [x[:, 1].tolist() for x in leaf], *counted]), [*_ARROW, *[pa.int64()] * 6])], UPDATED.names)

    none = F.array().cast("array<struct<start:bigint,end:bigint,text:string>>")
    edits = F.coalesce(F.col("edits").cast("array<struct<start:bigint,end:bigint,text:string>>"), none) if "edits" in trees.columns else none
    return trees.select(*TREES.names, F.filter(edits, lambda e: e.isNotNull()).alias("edits")).mapInArrow(released(updated), UPDATED)


def count(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """COUNTS of ``docs`` (``doc_id``, ``text``, ``edits``) before and after their edits, from trees that aren't stored in between.

    Nulls, repeated rows and empty tables are as in ``build`` and ``update``.
    """
    keep = ["edits"] if "edits" in docs.columns else []
    return update(build(docs, *keep, vocabulary=vocabulary), vocabulary).select(*COUNTS)


def gathered(docs: DataFrame, edits: DataFrame) -> DataFrame:
    """``docs`` with the edits of a table (doc_id, seq, start, end, text), in the order of ``seq``."""
    own = edits.groupBy("doc_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("seq", "start", "end", "text"))), lambda e: F.struct(e["start"].alias("start"), e["end"].alias("end"), e["text"].alias("text"))).alias("edits"))
    return docs.drop("edits").join(own, "doc_id", "left")


def sample_edits(text: F.Column, doc_id: F.Column) -> F.Column:
    """A deletion, a replacement inside a word and an insertion, at places that depend on the id alone."""
    n = F.length(text)
    place = lambda k: F.pmod(F.xxhash64(doc_id, F.lit(k)), F.greatest(n, F.lit(1)).cast("long"))
    one = lambda s, size, t: F.struct(s.cast("long").alias("start"), (s + size).cast("long").alias("end"), F.lit(t).alias("text"))
    return F.array(one(place(1), 40, ""), one(place(2), 3, "Edit, 12"), one(place(3), 0, " inserted words\nhere "))
