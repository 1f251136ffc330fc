"""Fast exact encoding inside tasks with the public ``tokenizers`` files."""

from __future__ import annotations

import json
import re
import sys
import types
from array import array

CACHE_WORDS = 100_000
"""Entries per cache of an encoder, which lives as long as its task; a cache starts anew beyond that."""


def worker_cache(name: str) -> dict:
    """A dict that lives as long as the Python worker, across its tasks."""
    home = sys.modules.setdefault("_sluice_worker_cache", types.ModuleType("_sluice_worker_cache"))
    return home.__dict__.setdefault(name, {})


def merge_ranks(path: str) -> dict[bytes, int] | None:
    """The BPE vocabulary of a ``tokenizers`` file as bytes, ids being the order of its merges; None for any other kind.

    A word-end suffix becomes the byte 0xFF, which no UTF-8 text holds: its
    merges with single bytes come before all others, as the model has them.
    """
    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    vocab, merges, end = model["vocab"], model["merges"], model.get("end_of_word_suffix") or ""
    first = len(vocab) - len(merges)
    pairs = (m.split(" ") if isinstance(m, str) else m for m in merges)
    if model["type"] != "BPE" or first != 256 * (1 + bool(end)) or any(vocab.get("".join(p)) != first + k for k, p in enumerate(pairs)):
        return None
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]  # bytes that spell themselves
    spelled = {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in own)}
    ranks = {}
    for token, i in vocab.items():
        core = token[:-len(end)] if end and token.endswith(end) else token
        ranks[bytes(spelled[c] for c in core) + b"\xff" * (core != token)] = i
    return ranks


class ByteEncoder:
    """Ids of whole texts by a byte-level BPE file of ``tokenizers``, as little-endian unsigned 32-bit bytes.

    The file's merges go to ``tiktoken``, which encodes alike and faster; texts
    of more than ``WHOLE`` characters are cut before a space that follows a
    character which is no white space, as no token spans such a place.  What
    holds no such place, and files of another kind, go through ``tokenizers``.
    Strings of special tokens are ordinary text.
    """

    WHOLE = 1 << 16
    PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = True
        self.fast, ranks = None, merge_ranks(path)
        if ranks:
            import tiktoken

            fast = tiktoken.Encoding("merges", pat_str=self.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
            probe = "It's  the\n\n  Straße, 1234 éàê\u2003x \x1c 漢字 I'LL\t"
            if fast(probe) == self.tok.encode(probe, add_special_tokens=False).ids:
                self.fast = fast

    def _parts(self, text: str):
        a = 0
        while len(text) - a > self.WHOLE:
            cut = text.rfind(" ", a + 1, a + self.WHOLE)
            while cut > a and text[cut - 1].isspace():
                cut = text.rfind(" ", a + 1, cut)
            if cut <= a:
                cut = a + self.WHOLE
                while (cut := text.find(" ", cut)) >= 0 and text[cut - 1].isspace():
                    cut += 1
                cut = cut if cut >= 0 else len(text)
            yield text[a:cut]
            a = cut
        yield text[a:]

    def _ids(self, text: str) -> list[int]:
        fits = self.fast and len(text) <= self.WHOLE
        return self.fast(text) if fits else self.tok.encode(text, add_special_tokens=False).ids

    def encode(self, texts: list[str]) -> list[bytes]:
        """One bytes object of ids per text."""
        return [b"".join(array("I", self._ids(part)).tobytes() for part in self._parts(t)) for t in texts]


class WordEncoder:
    """Ids of whole texts, as little-endian unsigned 32-bit bytes.

    For tokenizers that split at white space and drop it, a text's ids are its
    words' ids in a row, so a distinct word is encoded once while it stays in
    the encoder's cache.  A word of letters with a tail of punctuation is the
    letters' ids and the tail's; plain lower-case letters go straight to the
    merges, all else through the whole tokenizer.  Texts with
    control characters that Python takes for white space and the tokenizer does
    not are encoded whole.  Strings of special tokens are ordinary text.
    """

    ODD = re.compile("[\x1c-\x1f]")
    TAIL = ".,:;!?#$%&*+-=/|()[]{}<>\""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = True
        self.words, self.cores, self.merges = {}, {}, None
        ranks = merge_ranks(path)
        if ranks:
            import tiktoken

            self.merges = tiktoken.Encoding("words", pat_str=r"\S+", mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_single_piece
        probe = ["Straße", "éàêñöū", "thnter", "a", "é"]
        self.direct = ranks is not None and all(self._direct(w.lower()) == self._whole(w) for w in probe)

    def _whole(self, text: str) -> bytes:
        return array("I", self.tok.encode(text, add_special_tokens=False).ids).tobytes()

    def _direct(self, core: str) -> bytes:
        return array("I", self.merges(core.encode() + b"\xff")).tobytes()

    def _learn(self, words: set[str]) -> None:
        cores, known = self.cores, self.words
        if len(cores) > CACHE_WORDS:
            cores.clear()
        if len(known) > CACHE_WORDS:
            known.clear()
        merges, tails, get = self.merges if self.direct else None, self.TAIL, cores.get
        for w in words:
            low = w.lower()
            core = low.rstrip(tails)
            if merges is None or not core.isalpha() or not core.isascii() and max(core) >= "\u0250":
                known[w] = self._whole(w)
                continue
            ids = get(core)
            if ids is None:
                ids = cores[core] = array("I", merges(core.encode() + b"\xff")).tobytes()
            if len(core) < len(low):
                tail = low[len(core):]
                if tail not in cores:
                    cores[tail] = self._whole(tail)
                ids += cores[tail]
            known[w] = ids

    def encode(self, texts: list[str]) -> list[bytes]:
        """One bytes object of ids per text."""
        out, get = [], self.words.get
        for t in texts:
            if self.ODD.search(t):
                out.append(self._whole(t))
                continue
            words = t.split()
            ids = list(map(get, words))
            if None in ids:
                self._learn({w for w, i in zip(words, ids) if i is None})
                new = map(get, words)
                ids = [i if i is not None else n for i, n in zip(ids, new)]
            out.append(b"".join(ids))
        return out
