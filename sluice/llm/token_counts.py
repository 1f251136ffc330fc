"""Token counts that follow edits, by segment trees over pre-tokens.

A tokenizer of this kind cuts a text into pre-tokens and encodes each on its
own, so a text's count is the sum of its pre-tokens'.  Each document keeps a
tree: a leaf stands for a run of pre-tokens and holds its characters and its
tokens, an inner node holds the sums of its two children.

An edit touches a stretch of text.  The leaf of the third character before the
stretch is found by the sums of characters on the way down; from that leaf's
start (pre-tokens look ahead by at most two characters and never back) the new
text is cut again, until behind the edit a cut falls on one of the old cuts:
from there on nothing changes.  Only these pre-tokens are encoded, and only
the sums above the leaves that hold them are renewed.
"""

from __future__ import annotations

import base64
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import id_key, restored, small_batches
from sluice.llm.tokens import worker_cache

LEAF = 64
"""Pre-tokens per leaf of a fresh tree."""
CONTEXT = 3
CACHE = 300_000
REDACT = re.compile(r"\d{1,3}(?:\.\d{1,3}){3}|\d{6,}", re.A)


class Counter:
    """Pre-tokens of texts and their numbers of tokens, by a ``tiktoken`` vocabulary file and its pattern."""

    def __init__(self, ranks: str, pattern: str):
        import regex
        import tiktoken

        cache = worker_cache(f"counts:{ranks}")
        if "encoding" not in cache:
            with open(ranks, "rb") as lines:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            cache.update(encoding=tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=table, special_tokens={}),
                         pattern=regex.compile(pattern), counts={})
        self.encode, self.pattern, self.counts = cache["encoding"].encode_ordinary, cache["pattern"], cache["counts"]

    def count(self, pieces: list[str]) -> list[int]:
        counts = self.counts
        got = list(map(counts.get, pieces))
        if None in got:
            if len(counts) > CACHE:
                counts.clear()
            for i, (p, n) in enumerate(zip(pieces, got)):
                if n is None:
                    n = counts.get(p)
                    if n is None:
                        n = counts[p] = len(self.encode(p))
                    got[i] = n
        return got


class Tree:
    """Sums of characters and tokens over the leaves of one text."""

    def __init__(self, chars: list[int], tokens: list[int]):
        self.load(chars, tokens)

    def load(self, chars, tokens) -> None:
        self.n = len(chars)
        self.size = 1 << max(0, self.n - 1).bit_length()
        pad = [0] * (self.size - self.n)
        self.chars = [0] * self.size + [*chars, *pad]
        self.tokens = [0] * self.size + [*tokens, *pad]
        for sums in (self.chars, self.tokens):
            for i in range(self.size - 1, 0, -1):
                sums[i] = sums[2 * i] + sums[2 * i + 1]

    @classmethod
    def build(cls, text: str, counter: Counter) -> Tree:
        pieces = counter.pattern.findall(text)
        counts = counter.count(pieces)
        sizes = list(map(len, pieces))
        cuts = range(0, len(pieces), LEAF)
        return cls([sum(sizes[a:a + LEAF]) for a in cuts], [sum(counts[a:a + LEAF]) for a in cuts])

    @property
    def leaves(self) -> tuple[list[int], list[int]]:
        return self.chars[self.size:self.size + self.n], self.tokens[self.size:self.size + self.n]

    def find(self, at: int) -> tuple[int, int]:
        """The leaf that holds character ``at`` and that leaf's first character."""
        i, start = 1, 0
        while i < self.size:
            i *= 2
            if at >= start + self.chars[i] and self.chars[i + 1]:
                start += self.chars[i]
                i += 1
        return i - self.size, start

    def put(self, leaf: int, chars: int, tokens: int) -> None:
        i = self.size + leaf
        self.chars[i], self.tokens[i] = chars, tokens
        while i > 1:
            i //= 2
            self.chars[i] = self.chars[2 * i] + self.chars[2 * i + 1]
            self.tokens[i] = self.tokens[2 * i] + self.tokens[2 * i + 1]

    def edit(self, old: str, start: int, end: int, new: str, counter: Counter) -> tuple[str, int]:
        """Replace ``old[start:end]`` by ``new``: the new text and how many pre-tokens were encoded again."""
        text = old[:start] + new + old[end:]
        if not self.n:
            self.load(*Tree.build(text, counter).leaves)
            return text, sum(1 for _ in counter.pattern.finditer(text))
        shift = len(new) - (end - start)
        first, a = self.find(max(0, start - CONTEXT))
        # Old cuts from the end of the edit on, and to the end of the leaf that each lies in.
        last, b = self.find(min(end, len(old) - 1))
        edge = b + self.chars[self.size + last]
        olds, at = set(), a
        fresh, sizes, done = [], [], a
        matches = counter.pattern.finditer(text, a)
        before = counter.pattern.finditer(old, a)
        while True:
            # Cut the old text up to the end of a leaf, then the new text until it meets one of these cuts.
            while at < edge:
                at = next(before).end()
                olds.add(at)
            met = done - shift in olds and done >= start + len(new)
            while not met and done - shift < edge and done < len(text):
                m = next(matches)
                fresh.append(m[0])
                done = m.end()
                met = done - shift in olds and done >= start + len(new)
            if met or done == len(text) or last + 1 >= self.n:
                break
            last += 1
            edge += self.chars[self.size + last]
        counts = counter.count(fresh)
        sizes = [len(p) for p in fresh]
        # The leaf in which the cuts met keeps what lies behind that place.
        tail = counter.pattern.findall(old, done - shift, edge) if done - shift < edge else []
        kept = counter.count(tail)
        total = sum(counts) + sum(kept)
        chars = sum(sizes) + sum(map(len, tail))
        if len(fresh) + len(tail) <= 4 * LEAF * (last - first + 1):
            self.put(first, chars, total)
            for leaf in range(first + 1, last + 1):
                self.put(leaf, 0, 0)
        else:
            # A long insertion gets leaves of its own.
            c, t = self.leaves
            pieces, n = sizes + list(map(len, tail)), counts + kept
            cuts = range(0, len(pieces), LEAF)
            c[first:last + 1] = [sum(pieces[i:i + LEAF]) for i in cuts]
            t[first:last + 1] = [sum(n[i:i + LEAF]) for i in cuts]
            self.load(c, t)
        return text, len(fresh)


def build_trees(docs: DataFrame, ranks: str, pattern: str, doc_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``doc_id, text`` and its tree's leaves ``chars, tokens`` (arrays; a null or empty text has none)."""
    def build(frames):
        counter = Counter(ranks, pattern)
        for pdf in frames:
            leaves = [Tree.build(t, counter).leaves for t in pdf["text"]]
            pdf["chars"] = [c for c, _ in leaves]
            pdf["tokens"] = [t for _, t in leaves]
            yield pdf

    small_batches(docs.sparkSession)
    rows = docs.select(id_key(doc_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    out = rows.mapInPandas(build, "doc_id string, text string, chars array<int>, tokens array<int>")
    return out.withColumn("doc_id", restored("doc_id", docs.schema[doc_col].dataType))


def redactions(text: str) -> list[tuple[int, int, str]]:
    """Edits that hide IPv4 addresses and numbers of six digits or more."""
    return [(m.start(), m.end(), "[ip]" if "." in m[0] else "[number]") for m in REDACT.finditer(text)]


def joined_edits(text: str, edits: list[tuple[int, int, str]], near: int = 8 * LEAF) -> list[tuple[int, int, str]]:
    """Edits less than ``near`` characters apart as one that spans them all: their regions would be encoded anew several times over."""
    out: list[tuple[int, int, list[str]]] = []
    for start, end, new in edits:
        if out and start - out[-1][1] < near:
            first, last, parts = out[-1]
            out[-1] = first, end, parts
            parts += [text[last:start], new]
        else:
            out.append((start, end, [new]))
    return [(start, end, "".join(parts)) for start, end, parts in out]


def apply_edits(trees: DataFrame, ranks: str, pattern: str, edits=redactions) -> DataFrame:
    """Edit the texts of ``build_trees`` rows and bring their trees up to date.

    ``edits`` gives a text's edits ``(start, end, replacement)`` in ascending
    order without overlaps, by places in the text as it is; those close to each
    other are made in one go.  Returns ``doc_id, text, chars, tokens`` after the
    edits, with ``n_tokens_before``, ``n_tokens``, ``n_edits`` and ``n_encoded``
    (pre-tokens encoded again).  Null and repeated ids are kept; other columns
    are left out.
    """
    def run(frames):
        import pandas as pd

        counter = Counter(ranks, pattern)
        for pdf in frames:
            rows = []
            for doc, text, chars, tokens in zip(pdf["doc_id"], pdf["text"], pdf["chars"], pdf["tokens"]):
                todo, before, encoded = edits(text), int(sum(tokens)), 0
                if todo:
                    tree = Tree([int(c) for c in chars], [int(t) for t in tokens])
                    for start, end, new in reversed(joined_edits(text, todo)):  # from the end: places before stay as they are
                        text, n = tree.edit(text, start, end, new, counter)
                        encoded += n
                    chars, tokens = tree.leaves
                rows.append((doc, text, chars, tokens, before, int(sum(tokens)), len(todo), encoded))
            yield pd.DataFrame(rows, columns=["doc_id", "text", "chars", "tokens", "n_tokens_before", "n_tokens", "n_edits", "n_encoded"])

    rows = trees.select(id_key("doc_id").alias("doc_id"), "text", "chars", "tokens")
    out = rows.mapInPandas(run, "doc_id string, text string, chars array<int>, tokens array<int>, "
                           "n_tokens_before long, n_tokens long, n_edits int, n_encoded long")
    return out.withColumn("doc_id", restored("doc_id", trees.schema["doc_id"].dataType))
