"""Cutting texts at blanks into pieces whose token ids can be looked up.

A byte-level BPE vocabulary with the pattern below never forms a token across the point
before a blank that stands between two non-space characters, nor across a line feed between
two. So a text's ids are the ids of its pieces in order, and most pieces repeat.
"""

from __future__ import annotations

import json
import re
import struct
from collections.abc import Callable
from itertools import filterfalse, islice

import numpy as np

from starloom.llm.common import ENTRY_BYTES, MEMO_BYTES

#: What keeps a text from being cut at every blank and line feed: two of them in a row, or any
#: other space (Python's notion of a space contains the pattern's, so a doubtful character
#: only makes a piece longer).
ODD = ["  ", " \n", "\n ", "\n\n", *(chr(c) for c in range(0x3001) if chr(c).isspace() and chr(c) not in " \n")]
SINGLE_BLANK = re.compile(r"(?<=\S) (?=\S)")
#: Marks that, after a letter or number, begin a match of their own.
MARKS = ".,;:!?%&#*$|"
ENDS = frozenset(MARKS)


def plain(text: str) -> bool:
    """Whether every blank and line feed of the text begins a piece."""
    return not any(map(text.__contains__, ODD))


def cut(text: str) -> list[str]:
    """The pieces of a text; all but the first have lost a leading blank unless they start
    with a line feed."""
    if plain(text):
        return text.replace("\n", " \n").split(" ")
    return SINGLE_BLANK.split(text)


def whole(piece: str) -> str:
    """The text of a piece that is not the first."""
    return piece if piece.startswith("\n") else " " + piece


def forget_younger(memo: dict) -> None:
    """Drop the half of the entries that came last: what occurs often is met early."""
    kept = dict(islice(memo.items(), len(memo) // 2))
    memo.clear()
    memo.update(kept)


class PieceIds:
    """Ids of whole texts (little-endian unsigned 32-bit) through a bounded piece memo.

    ``encode`` maps a list of strings to a list of id bytes; it sees each distinct piece once
    per filling of the memo. Beyond ``budget`` bytes the memo goes back to the half it learned
    first, which holds the frequent pieces.
    """

    def __init__(self, encode: Callable[[list[str]], list[bytes]], budget: int = MEMO_BYTES):
        self.encode = encode
        self.budget = budget
        self.held = 0
        self.after: dict[str, bytes] = {}
        self.first: dict[str, bytes] = {}
        #: the pieces but the first ones that the last call of ``parts`` learned
        self.learned: set[str] = set()

    def _fill(self, memo: dict, missing: list[str], full: Callable[[str], str]) -> None:
        for i in range(0, len(missing), 20_000):
            part = missing[i : i + 20_000]
            found = self.encode([full(p) for p in part])
            memo.update(zip(part, found, strict=True))
            self.held += sum(map(len, part)) + sum(map(len, found)) + ENTRY_BYTES * len(part)

    def parts(self, texts: list[str]) -> tuple[list[list[str]], list[list[bytes]]]:
        """The pieces of each text and the ids of each piece.

        Every piece is looked up once; only those that were not there are looked up again.
        """
        if self.held > self.budget:
            forget_younger(self.after)
            forget_younger(self.first)
            self.held = sum(ENTRY_BYTES + len(k) + len(v) for memo in (self.after, self.first) for k, v in memo.items())
        cuts = [cut(t) for t in texts]
        get = self.after.get
        found = [list(map(get, c)) for c in cuts]
        missing: set[str] = set()
        holes = []
        for c, ids in zip(cuts, found, strict=True):
            ids[0] = b""  # a text's first piece has a memo of its own
            if None in ids:
                at = [k for k, x in enumerate(ids) if x is None]
                holes.append((c, ids, at))
                missing.update([c[k] for k in at])
        self.learned = missing
        self._fill(self.first, list({c[0] for c in cuts}.difference(self.first)), str)
        self._fill(self.after, list(missing), whole)
        after, first = self.after, self.first
        for c, ids, at in holes:
            for k in at:
                ids[k] = after[c[k]]
        for c, ids in zip(cuts, found, strict=True):
            ids[0] = first[c[0]]
        return cuts, found

    def ids(self, texts: list[str]) -> list[bytes]:
        return [b"".join(ids) for ids in self.parts(texts)[1]]


def byte_of_letter() -> dict[str, int]:
    """The letters that byte-level vocabularies write bytes with: printable ones stand for
    themselves, the others follow from U+0100 on."""
    plain_bytes = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain_bytes]
    return {chr(b): b for b in plain_bytes} | {chr(256 + i): b for i, b in enumerate(others)}


def ranks_of(definition: bytes) -> dict[bytes, int] | None:
    """Token bytes -> id of a tokenizer definition that is plain byte-level BPE by ranks (ids in
    the order of the merges, no normalizer, the library's own pattern); None for any other."""
    spec = json.loads(definition)
    model, cutter = spec["model"], spec.get("pre_tokenizer") or {}
    expected = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
    if spec.get("normalizer") or {k: cutter.get(k) for k in expected} != expected or model.get("type") != "BPE":
        return None
    if any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")):
        return None
    pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    made = [model["vocab"][a + b] for a, b in pairs]
    if made != sorted(made):
        return None
    letters, special = byte_of_letter(), {t["content"] for t in spec.get("added_tokens", [])}
    return {bytes(letters[c] for c in t): i for t, i in model["vocab"].items() if t not in special}


def library_encoder(definition: bytes, pattern: str | None = None) -> Callable[[list[str]], list[bytes]]:
    """Ids by a tokenizers definition; special tokens' strings are ordinary text.

    With ``pattern`` (the one the definition's byte-level cutter uses), a definition that is
    byte-level BPE by ranks runs in tiktoken, which gives the same ids in less time.
    """
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    formats = [struct.Struct(f"<{n}I") for n in range(33)]

    def pack(ids: list[int]) -> bytes:
        return formats[len(ids)].pack(*ids) if len(ids) < len(formats) else np.array(ids, "<u4").tobytes()

    ranks = ranks_of(definition) if pattern else None
    if ranks is not None:
        import tiktoken

        encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        return lambda strings: [pack(encoding.encode_ordinary(s)) for s in strings]
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_buffer(definition)
    tokenizer.encode_special_tokens = True

    def encode(strings: list[str]) -> list[bytes]:
        out = []
        for i in range(0, len(strings), 5_000):
            found = tokenizer.encode_batch_fast(strings[i : i + 5_000], add_special_tokens=False)
            out += [pack(e.ids) for e in found]
        return out

    return encode


#: Lower-case Latin-1 letters: unchanged by normalizing, and one match of a letter pattern.
LATIN_WORD = re.compile("[a-z\u00df-\u00f6\u00f8-\u00ff]+")


def drops_spaces(definition: bytes) -> bool:
    """Whether a definition lower-cases, drops white space between matches and marks word ends,
    so that a text's ids are those of its space-separated words, each by itself."""
    spec = json.loads(definition)
    steps = (spec.get("normalizer") or {}).get("normalizers", [])
    cutters = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
    return (
        [s["type"] for s in steps] == ["NFC", "Replace", "Lowercase"]
        and [c["type"] for c in cutters] == ["Split", "ByteLevel"]
        and cutters[0]["behavior"] == "Removed"
        and cutters[0]["invert"]
        and r"[^\s\p{L}\p{N}]+" in cutters[0]["pattern"].get("Regex", "")
        and bool(spec["model"].get("end_of_word_suffix"))
    )


class WordIds:
    """Ids of whole texts for a definition that ``drops_spaces``, through a bounded word memo.

    Plain lower-case words go straight to the library's model (they are one match, which the
    normalizer leaves alone); everything else takes the whole tokenizer.
    """

    def __init__(self, definition: bytes):
        from tokenizers import Tokenizer

        self.library = library_encoder(definition)
        self.model = Tokenizer.from_buffer(definition).model
        self.letters = {b: c for c, b in byte_of_letter().items()}
        self.memo: dict[bytes, bytes] = {}
        self.held = 0

    def _encode(self, words: list[bytes]) -> list[bytes]:
        texts = [w.decode("utf-8", "surrogatepass") for w in words]
        out, others = [b""] * len(words), []
        for i, t in enumerate(texts):
            if LATIN_WORD.fullmatch(t):
                mapped = t if t.isascii() else words[i].decode("latin-1").translate(self.letters)
                ids = [x.id for x in self.model.tokenize(mapped)]
                out[i] = struct.pack(f"<{len(ids)}I", *ids)
            else:
                others.append(i)
        for i, ids in zip(others, self.library([texts[i] for i in others]), strict=True):
            out[i] = ids
        return out

    def _learn(self, missing: set[bytes]) -> None:
        made, stems = [], set()
        marks, ends = MARKS.encode(), frozenset(MARKS.encode())
        for w in missing:
            body = w.rstrip(marks) if w[-1] in ends else w
            if body and len(body) < len(w) and body.decode("utf-8", "surrogatepass")[-1].isalnum():
                made.append((w, body, w[len(body) :]))
                stems.update((body, w[len(body) :]))
            else:
                stems.add(w)
        new = list(stems.difference(self.memo))
        self.memo.update(zip(new, self._encode(new), strict=True))
        self.held += sum(len(w) + len(self.memo[w]) for w in new) + ENTRY_BYTES * len(new)
        for w, body, tail in made:
            self.memo[w] = self.memo[body] + self.memo[tail]
            self.held += ENTRY_BYTES + len(w) + len(self.memo[w])

    def ids(self, texts: list[str]) -> list[bytes]:
        if self.held > MEMO_BYTES:
            forget_younger(self.memo)
            self.held = sum(ENTRY_BYTES + len(k) + len(v) for k, v in self.memo.items())
        words = [t.encode("utf-8", "surrogatepass").lower().split() for t in texts]
        missing: set[bytes] = set()
        for w in words:
            missing.update(filterfalse(self.memo.__contains__, w))
        self._learn(missing)
        get = self.memo.__getitem__
        return [b"".join(map(get, w)) for w in words]


def slices(texts: list[str], chars: int = 6_000_000):
    """Index ranges of consecutive texts of about ``chars`` characters together."""
    start = size = 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= chars:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)
