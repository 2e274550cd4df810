"""Token counts that follow edits, by a segment tree of pre-tokens per document.

A text is cut into pre-tokens by the tokenizer's pattern; its tokens are the sum over them. Leaves
of a document's tree hold some pre-tokens each, with their characters and tokens; inner nodes hold
the sums. An edit (position, characters removed, text inserted) finds its leaf by the character
sums. Pre-tokens are cut anew from the last leaf that begins at least two characters before the
edit (the pattern looks no further ahead), until a cut behind the edit meets an old leaf's
beginning: from there on text and cuts are the old ones. Only the leaves between are encoded again,
and the sums above them updated. Leaves that grow too large are split.

A document's state is columns: the text, and per leaf its characters and tokens; sums are rebuilt
from them when a document is read. Edits of a document apply in order, each to the text the former
ones left; positions are counted in code points and cut to the text's length. Null texts count as
empty, with no tokens; null edits as none. Repeated rows are counted each; extra columns are kept.
An empty table gives an empty result. Special tokens in a text are ordinary text.
"""

from __future__ import annotations

import base64
from bisect import bisect_right
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trafficlens.llm.common import documents, slices

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: the pre-token pattern that belongs to this vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
CONTEXT = 2
LEAF = 32
CACHE = 400_000
INTS = T.ArrayType(T.IntegerType())
EDITS = "array<struct<at:int,removed:int,inserted:string>>"


class Counter(dict):
    """Pre-token -> number of its tokens, remembered while they are few."""

    def __init__(self, vocabulary: bytes):
        import regex
        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, vocabulary.splitlines())}
        self.encode = tiktoken.Encoding("given", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.cut = regex.compile(PATTERN)

    def __missing__(self, piece: str) -> int:
        if len(self) >= CACHE:
            self.clear()
        value = self[piece] = len(self.encode(piece))
        return value

    def leaves(self, text: str) -> tuple[list[int], list[int]]:
        """Characters and tokens of each leaf of a text."""
        pieces = self.cut.findall(text)
        tokens = list(map(self.__getitem__, pieces))
        lengths = list(map(len, pieces))
        at = range(0, len(pieces), LEAF)
        return [sum(lengths[i : i + LEAF]) for i in at], [sum(tokens[i : i + LEAF]) for i in at]


class Tree:
    """Sums of characters and tokens over the leaves of one document."""

    def __init__(self, text: str, chars: list[int], tokens: list[int], counter: Counter):
        self.text, self.counter, self.encoded = text, counter, 0
        self._build(chars, tokens)

    def _build(self, chars: list[int], tokens: list[int]) -> None:
        self.n = max(1, len(chars))
        self.size = 1 << (self.n - 1).bit_length()
        self.chars = [0] * self.size + chars + [0] * (self.size - len(chars))
        self.tokens = [0] * self.size + tokens + [0] * (self.size - len(tokens))
        for i in range(self.size - 1, 0, -1):
            self.chars[i] = self.chars[2 * i] + self.chars[2 * i + 1]
            self.tokens[i] = self.tokens[2 * i] + self.tokens[2 * i + 1]

    @property
    def total(self) -> int:
        return self.tokens[1]

    def leaves(self) -> tuple[list[int], list[int]]:
        return self.chars[self.size : self.size + self.n], self.tokens[self.size : self.size + self.n]

    def leaf_at(self, position: int) -> tuple[int, int]:
        """The last leaf that begins at or before a position, and its beginning."""
        node, begin = 1, 0
        while node < self.size:
            left = self.chars[2 * node]
            if position < begin + left or self.chars[2 * node + 1] == 0:
                node = 2 * node
            else:
                node, begin = 2 * node + 1, begin + left
        return node - self.size, begin

    def _set(self, leaf: int, chars: int, tokens: int) -> None:
        node = self.size + leaf
        more_chars, more_tokens = chars - self.chars[node], tokens - self.tokens[node]
        while node:
            self.chars[node] += more_chars
            self.tokens[node] += more_tokens
            node >>= 1

    def edit(self, at: int, removed: int, inserted: str) -> None:
        old = len(self.text)
        at = min(max(at, 0), old)
        removed = min(max(removed, 0), old - at)
        if not removed and not inserted:
            return
        shift = len(inserted) - removed
        self.text = text = self.text[:at] + inserted + self.text[at + removed :]
        first, begin = self.leaf_at(max(0, at - CONTEXT))
        # Beginnings of old leaves behind the edit, in the new text; empty leaves share theirs.
        last, meet = self.leaf_at(at + removed)
        pieces, position = [], begin
        match = self.counter.cut.match
        # Old beginnings are read off leaf by leaf, as far as the new cuts go.
        while position < len(text):
            while last < self.n and (meet + shift < position or meet < at + removed):
                meet += self.chars[self.size + last]
                last += 1
            if last < self.n and meet + shift == position and position >= at + len(inserted) and last > first:
                break
            end = match(text, position).end()
            pieces.append(text[position:end])
            position = end
        else:
            last = self.n
        self.encoded += len(pieces)
        tokens = [self.counter[p] for p in pieces]
        if len(pieces) > 2 * LEAF * max(1, last - first):
            chars, counts = self.leaves()
            at_pieces = range(0, len(pieces), LEAF)
            self._build(
                chars[:first] + [sum(map(len, pieces[i : i + LEAF])) for i in at_pieces] + chars[last:],
                counts[:first] + [sum(tokens[i : i + LEAF]) for i in at_pieces] + counts[last:])
            return
        # The touched leaves share the new pieces evenly; some may stay empty.
        share = -(-len(pieces) // max(1, last - first))
        for j, leaf in enumerate(range(first, max(last, first + 1))):
            part = slice(j * share, (j + 1) * share)
            self._set(leaf, sum(map(len, pieces[part])), sum(tokens[part]))


def _texts(column: pa.Array) -> list[str]:
    return [t or "" for t in column.to_pylist()]


def _builder(vocabulary):
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(vocabulary.value)
        for part in slices(batches, "_text"):
            chars, tokens = zip(*[counter.leaves(t) for t in _texts(part.column("_text"))])
            yield pa.RecordBatch.from_arrays(
                [*part.columns, pa.array(chars, pa.list_(pa.int32())), pa.array(tokens, pa.list_(pa.int32())), pa.array(map(sum, tokens), pa.int64())],
                names=[*part.schema.names, "_chars", "_tokens", "_n"])

    return build


def _editor(vocabulary):
    def edit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(vocabulary.value)
        for part in slices(batches, "_text"):
            out: list[list] = [[], [], [], [], []]
            columns = [part.column(c).to_pylist() for c in ("_chars", "_tokens", "_edits")]
            for text, chars, tokens, edits in zip(_texts(part.column("_text")), *columns):
                tree = Tree(text, chars or [], tokens or [], counter)
                for e in edits or []:
                    if e is not None:
                        tree.edit(e["at"] or 0, e["removed"] or 0, e["inserted"] or "")
                chars, tokens = tree.leaves()
                for values, value in zip(out, (tree.text, chars, tokens, tree.total, tree.encoded)):
                    values.append(value)
            kinds = (pa.string(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.int64(), pa.int64())
            kept = part.drop_columns(["_text", "_chars", "_tokens", "_edits"])
            yield pa.RecordBatch.from_arrays([*kept.columns, *map(pa.array, out, kinds)], names=[*kept.schema.names, "_text", "_chars", "_tokens", "_n", "_encoded"])

    return edit


def _shared(df: DataFrame, tokenizer: str):
    with open(tokenizer, "rb") as file:
        return df.sparkSession.sparkContext.broadcast(file.read())


STATE = ("leaf_chars", "leaf_tokens", "n_tokens")


def count_tokens(docs: DataFrame, text_col: str = "text", tokenizer: str = TOKENIZER) -> DataFrame:
    """The documents with their trees' leaves (leaf_chars, leaf_tokens) and n_tokens."""
    columns = [c for c in docs.columns if c not in (*STATE, text_col)]
    fields = [T.StructField(f"_{i}", docs.schema[c].dataType) for i, c in enumerate(columns)]
    schema = T.StructType([*fields, T.StructField("_text", T.StringType())])
    for name, kind in (("_chars", INTS), ("_tokens", INTS), ("_n", "long")):
        schema = schema.add(name, kind)
    rows = docs.select(*[F.col(f"`{c}`").alias(f"_{i}") for i, c in enumerate(columns)], F.col(f"`{text_col}`").alias("_text"))
    found = rows.mapInArrow(_builder(_shared(docs, tokenizer)), schema)
    names = {f"_{i}": c for i, c in enumerate(columns)} | {"_text": text_col, "_chars": STATE[0], "_tokens": STATE[1], "_n": STATE[2]}
    return found.select(*[F.col(a).alias(b) for a, b in names.items()])


def apply_edits(state: DataFrame, edits: str = "edits", text_col: str = "text", tokenizer: str = TOKENIZER) -> DataFrame:
    """The state after each row's edits, an array of (at, removed, inserted); n_encoded pre-tokens were encoded anew."""
    columns = [c for c in state.columns if c not in (*STATE, text_col, edits, "n_encoded")]
    fields = [T.StructField(f"_{i}", state.schema[c].dataType) for i, c in enumerate(columns)]
    schema = T.StructType([*fields, T.StructField("_text", T.StringType())])
    for name, kind in (("_chars", INTS), ("_tokens", INTS), ("_n", "long"), ("_encoded", "long")):
        schema = schema.add(name, kind)
    rows = state.select(
        *[F.col(f"`{c}`").alias(f"_{i}") for i, c in enumerate(columns)], F.col(f"`{text_col}`").alias("_text"),
        F.col(STATE[0]).alias("_chars"), F.col(STATE[1]).alias("_tokens"), F.col(f"`{edits}`").cast(EDITS).alias("_edits"))
    found = rows.mapInArrow(_editor(_shared(state, tokenizer)), schema)
    names = {f"_{i}": c for i, c in enumerate(columns)} | {"_text": text_col, "_chars": STATE[0], "_tokens": STATE[1], "_n": STATE[2], "_encoded": "n_encoded"}
    return found.select(*[F.col(a).alias(b) for a, b in names.items()])


def gather_edits(state: DataFrame, edits: DataFrame, key: str = "doc_id", order: str = "seq", into: str = "edits") -> DataFrame:
    """The state with the edits of a table (key, order, at, removed, inserted) as one array per row.

    Rows that share a key get the same edits, those with a null key the edits of null keys. Rows without
    edits get a null array. Edits of equal order follow by place, so reruns agree; a column of the state
    that is named as ``into`` is replaced, other columns stay in order. The edits of one document meet in
    one row, as they are applied one after the other.
    """
    step = F.struct(F.col(f"`{order}`").alias("_order"), "at", "removed", "inserted")
    listed = edits.select(F.col(f"`{key}`").alias("_key"), step.alias("_step")).groupBy("_key").agg(F.sort_array(F.collect_list("_step")).alias("_steps"))
    # The state's columns travel under numbers, so that none clashes with those used here.
    rows = state.select(*[F.col(f"`{c}`").alias(f"_{i}") for i, c in enumerate(state.columns)])
    joined = rows.join(listed, F.col(f"_{state.columns.index(key)}").eqNullSafe(F.col("_key")), "left")
    found = F.transform("_steps", lambda e: F.struct(e["at"].alias("at"), e["removed"].alias("removed"), e["inserted"].alias("inserted")))
    kept = [F.col(f"_{i}").alias(c) for i, c in enumerate(state.columns) if c != into]
    return joined.select(*kept, found.alias(into))


def revisions(text: Column) -> Column:
    """Three edits of a text made of itself: some characters replaced, some inserted, some removed."""
    n = F.length(text)
    edit = lambda at, removed, inserted: F.struct(
        F.floor(at).cast("int").alias("at"), F.lit(removed).alias("removed"), inserted.alias("inserted"))
    return F.array(
        edit(n / 3, 7, F.upper(F.substring(text, F.floor(n / 2).cast("int"), F.lit(7)))),
        edit(2 * n / 3, 0, F.substring(text, 1, 20)),
        edit(n / 5, 11, F.lit("")),
    )


def op3_token_counts(spark, folder: str) -> DataFrame:
    """Tokens of every document, and after three edits of it, with the pre-tokens encoded for these."""
    state = count_tokens(documents(spark, folder).select("doc_id", "text"))
    state = state.withColumn("before", F.col("n_tokens")).withColumn("edits", revisions(F.col("text")))
    edited = apply_edits(state)
    return edited.select("doc_id", F.col("before").alias("n_tokens"), F.col("n_tokens").alias("n_tokens_edited"), "n_encoded")
