"""Token counts that follow edits.

Per document a segment tree is kept: its leaves are runs of about ``LEAF`` pieces (see
``pieces``: the points between pieces are never crossed by a token), each with its characters
and tokens; inner nodes hold the sums of their two children. An edit replaces a character range.
The leaves it touches, with one more on either side as context, are cut and encoded again; all
others keep their counts, and only the sums above replaced leaves are renewed. A boundary of the
new text is trusted only where it is a piece boundary of the new text too; where the edit has
removed it, the region grows leaf by leaf until both its ends are.

``with_trees`` adds the state to a table of documents, ``apply_edits`` brings text, tree and
count up to date; both are single passes without a shuffle.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm.common import worker_state
from starloom.llm.pieces import PieceIds, cut, library_encoder, plain, slices

#: Pieces per leaf when a text is cut into leaves.
LEAF = 32
#: Pieces a worker remembers, characters it handles at once and rows it hands back at once:
#: texts, leaves and trees are in memory side by side here.
MEMO = 64_000_000
SLICE = 1_000_000
ROWS = 500
TREE = "struct<leaves:int,chars:array<int>,tokens:array<int>>"
EDIT = "struct<start:int,stop:int,insert:string>"
UPDATED = f"struct<text:string,tree:{TREE},n_tokens:bigint,reencoded:bigint>"
ARROW_TREE = pa.struct([("leaves", pa.int32()), ("chars", pa.list_(pa.int32())), ("tokens", pa.list_(pa.int32()))])
ARROW_UPDATED = pa.struct([("text", pa.string()), ("tree", ARROW_TREE), ("n_tokens", pa.int64()), ("reencoded", pa.int64())])


def leaf_texts(text: str) -> list[str]:
    """The text in runs of LEAF pieces."""
    pieces = cut(text)
    if len(pieces) <= LEAF:
        return [text] if text else []
    # every piece but the first has lost one blank, unless it is one that starts with a line
    # feed in a plain text
    lengths = [len(pieces[0])]
    if plain(text):
        lengths += [len(p) + (p[:1] != "\n") for p in pieces[1:]]
    else:
        lengths += [len(p) + 1 for p in pieces[1:]]
    ends = list(accumulate(lengths))[LEAF - 1 :: LEAF]
    if not ends or ends[-1] < len(text):
        ends.append(len(text))
    return [text[a:b] for a, b in zip([0, *ends], ends, strict=False)]


def is_boundary(text: str, at: int) -> bool:
    """Whether no token can cross this place: before a lone blank or line feed."""
    if at <= 0 or at >= len(text):
        return True
    return text[at] in " \n" and not text[at - 1].isspace() and at + 1 < len(text) and not text[at + 1].isspace()


class Tree:
    """A segment tree over leaf counts: node 1 is the root, node i has children 2i and 2i + 1."""

    def __init__(self, leaves: int, chars: list[int], tokens: list[int]):
        self.leaves, self.chars, self.tokens = leaves, chars, tokens

    @classmethod
    def build(cls, chars: list[int], tokens: list[int]) -> Tree:
        size = 1 << max(0, len(chars) - 1).bit_length()
        blank = [0] * size
        tree = cls(len(chars), blank + chars + [0] * (size - len(chars)), blank + tokens + [0] * (size - len(tokens)))
        for i in range(size - 1, 0, -1):
            tree.sum(i)
        return tree

    def sum(self, i: int) -> None:
        self.chars[i] = self.chars[2 * i] + self.chars[2 * i + 1]
        self.tokens[i] = self.tokens[2 * i] + self.tokens[2 * i + 1]

    @property
    def size(self) -> int:
        return len(self.chars) // 2

    @property
    def total(self) -> int:
        return self.tokens[1] if self.leaves else 0

    def find(self, at: int) -> tuple[int, int]:
        """The leaf that holds a character (the last leaf for places beyond), and its start."""
        i, start = 1, 0
        while i < self.size:
            i *= 2
            if at >= start + self.chars[i]:
                start += self.chars[i]
                i += 1
        leaf = i - self.size
        if leaf >= self.leaves:
            leaf = self.leaves - 1
            start = self.chars[1] - self.chars[self.size + leaf]
        return leaf, start

    def replace(self, first: int, last: int, chars: list[int], tokens: list[int]) -> Tree:
        """Put new leaves in the place of leaves first..last. While their number stays the same
        only the sums above them are renewed, else the tree is laid out again from the counts."""
        if len(chars) != last - first + 1:
            a, b, n = self.size + first, self.size + last + 1, self.size + self.leaves
            return Tree.build(self.chars[self.size : a] + chars + self.chars[b:n], self.tokens[self.size : a] + tokens + self.tokens[b:n])
        dirty = set()
        for k, (c, t) in enumerate(zip(chars, tokens, strict=True)):
            i = self.size + first + k
            self.chars[i], self.tokens[i] = c, t
            dirty.add(i >> 1)
        while dirty:
            above = set()
            for i in dirty:
                if i:
                    self.sum(i)
                    above.add(i >> 1)
            dirty = above - {0}
        return self


def edited(text: str, tree: Tree, edits: list[tuple[int, int, str]], count) -> tuple[str, Tree, int]:
    """The new text, its tree and how many characters were encoded again.

    ``edits`` are (start, stop, insert) against the given text; ranges are clamped to it and
    applied from the last to the first; of two that overlap the later one in text order yields.
    ``count(list of strings)`` gives token counts.
    """
    again, limit = 0, len(text) + 1
    for start, stop, insert in sorted(edits, key=lambda e: (e[0], e[1]), reverse=True):
        start = max(0, min(start, len(text)))
        stop = max(start, min(stop, len(text)))
        if stop > limit:
            continue  # overlaps an edit already made
        limit = start
        new = text[:start] + insert + text[stop:]
        if not tree.leaves:
            region_start, region_stop, first, last = 0, len(new), 0, -1
        else:
            first, region_start = tree.find(start)
            last, last_start = tree.find(max(start, stop - 1))
            region_stop = last_start + tree.chars[tree.size + last]
            shift = len(new) - len(text)
            context = 1  # one more leaf on either side
            while first > 0 and (context or not is_boundary(new, region_start)):
                first, context = first - 1, 0
                region_start -= tree.chars[tree.size + first]
            context = 1
            while last < tree.leaves - 1 and (context or not is_boundary(new, region_stop + shift)):
                last, context = last + 1, 0
                region_stop += tree.chars[tree.size + last]
            if not is_boundary(new, region_start):
                first, region_start = 0, 0
            if not is_boundary(new, region_stop + shift):
                last, region_stop = tree.leaves - 1, len(text)
            region_stop += shift
        region = new[region_start:region_stop]
        parts = leaf_texts(region)
        again += len(region)
        chars, tokens = [len(p) for p in parts], count(parts)
        if last < first:
            tree = Tree.build(chars, tokens)
        else:
            tree = tree.replace(first, last, chars, tokens)
        text = new
    return text, tree, again


def _counter(shared, key, pattern):
    ids = worker_state(key, lambda: PieceIds(library_encoder(shared.value, pattern), MEMO))
    return lambda strings: [len(x) // 4 for x in ids.ids(strings)]


def _share(spark: SparkSession, tokenizer_file: str, pattern: str | None):
    with open(tokenizer_file, "rb") as f:
        data = f.read()
    return spark.sparkContext.broadcast(data), ("token_counts", zlib.crc32(data), pattern)


def tree_of(spark: SparkSession, tokenizer_file: str, pattern: str | None = None):
    """A column function text -> tree."""
    shared, key = _share(spark, tokenizer_file, pattern)

    @F.arrow_udf(TREE)
    def build(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        count = _counter(shared, key, pattern)
        for array in texts:
            done = [pa.array([], ARROW_TREE)]
            for k in range(0, len(array), ROWS):
                values, out = [t or "" for t in array[k : k + ROWS].to_pylist()], []
                for i, j in slices(values, SLICE):
                    parts = [leaf_texts(t) for t in values[i:j]]
                    counts = iter(count([p for ps in parts for p in ps]))
                    for ps in parts:
                        tree = Tree.build([len(p) for p in ps], [next(counts) for _ in ps])
                        out.append({"leaves": tree.leaves, "chars": tree.chars, "tokens": tree.tokens})
                done.append(pa.array(out, ARROW_TREE))
            yield pa.concat_arrays(done)

    return build


def with_trees(documents: DataFrame, tokenizer_file: str, pattern: str | None = None) -> DataFrame:
    """``doc_id, text, tree, n_tokens`` of every document: the state that edits are applied to.

    Null texts count as empty (no leaf, 0 tokens). Other columns are not carried.
    """
    build = tree_of(documents.sparkSession, tokenizer_file, pattern)
    rows = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.select("doc_id", "text", build("text").alias("tree"))
    total = F.when(F.col("tree.leaves") > 0, F.get(F.col("tree.tokens"), F.lit(1))).otherwise(0)
    return rows.select("doc_id", "text", "tree", total.cast("long").alias("n_tokens"))


def attach_edits(state: DataFrame, edits: DataFrame) -> DataFrame:
    """``state`` with a column ``edits`` from an edit log ``doc_id, start, stop, insert``.

    A log's edits refer to the document's current text. Null starts and stops are dropped, a
    null insert deletes. Every row of an id gets its edits; documents without any get none.
    """
    log = edits.where(F.col("doc_id").isNotNull() & F.col("start").isNotNull() & F.col("stop").isNotNull())
    one = F.struct(F.col("start").cast("int").alias("start"), F.col("stop").cast("int").alias("stop"), F.coalesce("insert", F.lit("")).alias("insert"))
    log = log.groupBy(F.col("doc_id").alias("edit_id")).agg(F.array_sort(F.collect_list(one)).alias("edits"))
    joined = state.join(log, state.doc_id == log.edit_id, "left").drop("edit_id")
    return joined.withColumn("edits", F.coalesce("edits", F.array().cast(f"array<{EDIT}>")))


def apply_edits(state: DataFrame, tokenizer_file: str, pattern: str | None = None) -> DataFrame:
    """``doc_id, text, tree, n_tokens`` after the edits, ``tokens_before``, ``n_edits`` and
    ``reencoded`` (characters encoded again). ``state`` has ``edits`` beside its own columns."""
    shared, key = _share(state.sparkSession, tokenizer_file, pattern)

    @F.arrow_udf(UPDATED)
    def update(texts: pa.Array, trees: pa.Array, edits: pa.Array) -> pa.Array:
        count = _counter(shared, key, pattern)
        done = [pa.array([], ARROW_UPDATED)]
        for k in range(0, len(texts), ROWS):
            out = []
            for text, tree, todo in zip(texts[k : k + ROWS], trees[k : k + ROWS], edits[k : k + ROWS], strict=True):
                found = tree.as_py()
                held, asked = Tree(found["leaves"], found["chars"], found["tokens"]), todo.as_py()
                new, again = text.as_py(), 0
                if asked:
                    new, held, again = edited(new, held, [(e["start"], e["stop"], e["insert"]) for e in asked], count)
                    found = {"leaves": held.leaves, "chars": held.chars, "tokens": held.tokens}
                out.append({"text": new, "tree": found, "n_tokens": held.total, "reencoded": again})
            done.append(pa.array(out, ARROW_UPDATED))
        return pa.concat_arrays(done)

    rows = state.select("doc_id", F.col("n_tokens").alias("tokens_before"), F.size("edits").alias("n_edits"), update("text", "tree", "edits").alias("u"))
    return rows.select("doc_id", "u.text", "u.tree", "u.n_tokens", "tokens_before", "n_edits", "u.reencoded")


EMAIL = re.compile(r"[\w.+-]+@[\w-]+\.[\w.-]*\w")
NUMBER = re.compile(r"\+?\d(?:[ .-]?\d){6,}")


def cleaning_edits(text: str) -> list[tuple[int, int, str]]:
    """The edits of a cleaning pass: mail addresses and long numbers are masked, lines that
    repeat an earlier line of the text are deleted with their line feed."""
    edits = [(m.start(), m.end(), "<number>") for m in NUMBER.finditer(text)]
    if "@" in text:
        edits += [(m.start(), m.end(), "<mail>") for m in EMAIL.finditer(text)]
    seen, at = set(), 0
    for line in text.split("\n"):
        if line in seen and at:
            edits.append((at - 1, at + len(line), ""))
        seen.add(line)
        at += len(line) + 1
    # longer ranges first where they overlap, so that a deleted line takes its masks with it
    chosen: list[tuple[int, int, str]] = []
    for edit in sorted(edits, key=lambda e: (e[0], -e[1])):
        if not chosen or edit[0] >= chosen[-1][1]:
            chosen.append(edit)
    return chosen


def follow_edits(documents: DataFrame, tokenizer_file: str, pattern: str | None = None, edits_of=cleaning_edits) -> DataFrame:
    """``with_trees`` and ``apply_edits`` in one pass, for edits that are found in the text
    itself: ``edits_of(text)`` gives them. Same columns and rules as ``apply_edits``.

    One Python worker per task sees a text once, instead of one for each step.
    """
    shared, key = _share(documents.sparkSession, tokenizer_file, pattern)
    names = ["doc_id", "text", "tree", "n_tokens", "tokens_before", "n_edits", "reencoded"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = _counter(shared, key, pattern)
        for batch in batches:
            for k in range(0, batch.num_rows, ROWS):
                part = batch.slice(k, ROWS)
                values = [t or "" for t in part.column(1).to_pylist()]
                for i, j in slices(values, SLICE):
                    parts = [leaf_texts(t) for t in values[i:j]]
                    counts, out = iter(count([p for ps in parts for p in ps])), []
                    for text, ps in zip(values[i:j], parts, strict=True):
                        tree = Tree.build([len(p) for p in ps], [next(counts) for _ in ps])
                        before, edits, again = tree.total, edits_of(text), 0
                        if edits:
                            text, tree, again = edited(text, tree, edits, count)
                        kept = {"leaves": tree.leaves, "chars": tree.chars, "tokens": tree.tokens}
                        out.append((text, kept, tree.total, before, len(edits), again))
                    kinds = [pa.string(), ARROW_TREE, pa.int64(), pa.int64(), pa.int32(), pa.int64()]
                    columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)]
                    yield pa.RecordBatch.from_arrays([part.column(0)[i:j], *columns], names)

    id_type = documents.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, text string, tree {TREE}, n_tokens long, tokens_before long, n_edits int, reencoded long"
    return documents.select("doc_id", "text").mapInArrow(run, schema)


def op1_token_counts(spark: SparkSession, documents: DataFrame, tokenizer_file: str, pattern: str) -> DataFrame:
    """Count every whole text's tokens, apply its cleaning edits, and follow them in the counts."""
    done = follow_edits(documents, tokenizer_file, pattern)
    return done.select("doc_id", "tokens_before", "n_edits", "n_tokens", "reencoded", F.crc32(F.col("text").cast("binary")).alias("text_crc32"))
