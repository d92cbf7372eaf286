"""Byte-level pre-tokens and the proof of which of them are one token.

``prove`` runs once on the driver, over the vocabulary and the characters
alone. It shows, by asking the tokenizer itself,

* which strings of the vocabulary, encoded alone, give exactly one token;
* for which characters ``PATTERN`` cuts a text as the tokenizer does (Unicode
  tables of two libraries need not agree on every character);
* that merges may be found by the rank of what they give (``merge_ranks``).

A pre-token's tokens depend on the pre-token alone, so wherever a proven string
is one, its tokens are known without a merge. ``Pieces`` holds what is known
inside a task and merges the rest. A text with a character that is not proven
is left to the tokenizer whole.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from functools import cached_property, lru_cache
from pathlib import Path

import numpy as np
import regex
import tiktoken
from tokenizers import Tokenizer

# Fixed value: the published pattern that cuts a text before byte-level merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: A vocabulary file is sent to every task; a larger one is refused.
MAX_FILE_BYTES = 64 << 20
#: Merged pre-tokens that a task remembers.
REMEMBERED = 1 << 18
#: Characters asked about: the basic plane and the pictographs.
_ASKED = (range(0, 0xD800), range(0xE000, 0x10000), range(0x1F000, 0x1FB00))


def _byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary: printable
    ones stand for themselves, the others follow from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(others)) for b in range(256)]


BYTE_LETTERS = _byte_letters()
_LETTER_BYTE = {c: b for b, c in enumerate(BYTE_LETTERS)}


def token_bytes(entry: str) -> bytes:
    """The bytes of a byte-level vocabulary entry."""
    return bytes(map(_LETTER_BYTE.__getitem__, entry))


def byte_level(source: str) -> bool:
    """Whether a tokenizer file is one that the shortcut is made for: merges
    over byte letters, cut by the byte-level pattern, nothing rewritten."""
    spec = json.loads(source)
    cut, model = spec.get("pre_tokenizer") or {}, spec.get("model") or {}
    plain = not spec.get("normalizer") and not spec.get("post_processor") and not model.get("dropout")
    affixes = model.get("continuing_subword_prefix") or model.get("end_of_word_suffix")
    whole = cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and not cut.get("add_prefix_space")
    return bool(plain and whole and model.get("type") == "BPE" and not affixes)


@dataclass(frozen=True)
class Proof:
    """``source`` is the tokenizer file; ``whole`` maps strings that are one
    token alone to its id; ``certain`` are the characters cut alike; ``added``
    are the strings that the tokenizer treats specially inside texts. ``ranks``
    and ``rank_ids`` are ``merge_ranks``; empty if nothing of the kind is proven."""

    source: str
    whole: dict[str, int]
    certain: frozenset[str]
    added: tuple[str, ...]
    ranks: dict[bytes, int]
    rank_ids: tuple[int, ...]

    def sure(self, text: str) -> bool:
        return text.isascii() or self.certain.issuperset(text)


def _probe(c: str) -> str:
    return f"a{c}1{c}!{c}{c} {c} "


def _cut_alike(tokenizer: Tokenizer) -> frozenset[str]:
    pattern, cut = regex.compile(PATTERN), tokenizer.pre_tokenizer.pre_tokenize_str

    def alike(text: str) -> bool:
        return [text[a:b] for _, (a, b) in cut(text)] == pattern.findall(text)

    out: list[str] = []
    for part in _ASKED:
        for low in range(part.start, part.stop, 256):
            some = [chr(c) for c in range(low, min(low + 256, part.stop))]
            out.extend(some if alike("".join(map(_probe, some))) else [c for c in some if alike(_probe(c))])
    return frozenset(out)


def merge_ranks(tokenizer: Tokenizer) -> tuple[dict[bytes, int], tuple[int, ...]]:
    """A rank for the bytes of every token (bytes first, then the merges in
    order), and the id of every rank, if merging whatever neighbours have the
    lowest rank together does what the list of merges does. Else empty.

    It does if every token comes from one merge, of tokens that rank lower, and
    gives itself when encoded alone: then lower ranks leave just that merge's two
    parts wherever neighbours make up the token."""
    model = json.loads(tokenizer.to_str())["model"]
    vocabulary = model["vocab"]
    if model.get("ignore_merges") or model.get("unk_token") or not all(c in vocabulary for c in BYTE_LETTERS):
        return {}, ()
    entries = {c: None for c in BYTE_LETTERS}
    for merge in model["merges"]:
        left, right = merge.split(" ") if isinstance(merge, str) else merge
        whole = left + right
        if left not in entries or right not in entries or whole in entries or whole not in vocabulary:
            return {}, ()
        entries[whole] = None
    alone = tokenizer.model.tokenize
    if any([t.id for t in alone(entry)] != [vocabulary[entry]] for entry in entries):
        return {}, ()
    return {token_bytes(entry): rank for rank, entry in enumerate(entries)}, tuple(vocabulary[entry] for entry in entries)


def prove(source: str) -> Proof:
    """The proof for a byte-level tokenizer file's content."""
    tokenizer = Tokenizer.from_str(source)
    added = tuple(t.content for t in tokenizer.get_added_tokens_decoder().values())
    tokenizer.encode_special_tokens = True
    strings: dict[str, int] = {}
    for entry, number in tokenizer.get_vocab(with_added_tokens=False).items():
        try:
            strings[token_bytes(entry).decode()] = number
        except (KeyError, UnicodeDecodeError):
            continue  # no text has it as a pre-token
    alone = tokenizer.encode_batch(list(strings), add_special_tokens=False)
    whole = {s: n for (s, n), e in zip(strings.items(), alone, strict=True) if e.ids == [n]}
    return Proof(source, whole, _cut_alike(tokenizer), added, *merge_ranks(tokenizer))


@lru_cache(maxsize=8)
def _proof_of(path: str, size: int, changed: int) -> Proof | str:
    source = Path(path).read_text(encoding="utf-8")
    return prove(source) if byte_level(source) else source


def read_tokenizer(path: str) -> Proof | str | bytes:
    """A tokenizer file as the driver sends it to the tasks: a ``Proof``, the
    content of another ``.json`` file, or the bytes of a ``.model`` file."""
    seen = Path(path).stat()
    if seen.st_size > MAX_FILE_BYTES:
        raise ValueError(f"{path} has {seen.st_size} bytes, more than {MAX_FILE_BYTES}")
    if not path.endswith(".json"):
        return Path(path).read_bytes()
    return _proof_of(path, seen.st_size, seen.st_mtime_ns)


class _Known(dict):
    """Ids of pre-tokens; those not proven are merged when first met, and at
    most ``REMEMBERED`` of them are kept."""

    def __init__(self, proof: Proof):
        super().__init__({s: (n,) for s, n in proof.whole.items()})
        self._proven = len(self)
        self._whole = proof.whole
        # One model of the tokenizer's own, without its pattern or special strings.
        self._merge = Tokenizer.from_str(proof.source).model.tokenize

    def __missing__(self, piece: str) -> tuple[int, ...]:
        if len(self) - self._proven >= REMEMBERED:
            self.clear()
            self.update((s, (n,)) for s, n in self._whole.items())
        ids = tuple(t.id for t in self._merge("".join(map(BYTE_LETTERS.__getitem__, piece.encode()))))
        self[piece] = ids
        return ids


class Pieces:
    """A task's view of a proof."""

    def __init__(self, proof: Proof):
        self.proof = proof
        self._pattern = regex.compile(PATTERN)
        self.known = _Known(proof)

    @cached_property
    def tokenizer(self) -> Tokenizer:
        return Tokenizer.from_str(self.proof.source)

    @cached_property
    def plain(self) -> Tokenizer:
        """The tokenizer with special strings taken as plain text."""
        out = Tokenizer.from_str(self.proof.source)
        out.encode_special_tokens = True
        return out

    def count(self, text: str) -> int:
        """Tokens of a text, special strings in it handled as the tokenizer does."""
        if not self.proof.sure(text) or any(s in text for s in self.proof.added):
            return len(self.tokenizer.encode(text, add_special_tokens=False))
        known = self.known
        return sum([len(known[piece]) for piece in self._pattern.findall(text)])

    def ids(self, text: str) -> list[int]:
        """Token ids of a text, special strings in it taken as plain text."""
        if not self.proof.sure(text):
            return self.plain.encode(text, add_special_tokens=False).ids
        known = self.known
        return [i for piece in self._pattern.findall(text) for i in known[piece]]

    def ids_of_each(self, chunks: list[str]) -> list[list[int]]:
        """``ids`` of texts that each begin with white space, many at a time."""
        proof = self.proof
        # White space is always cut from another character before it, so texts that end
        # in one can be cut in one go. The null character is kept to part the pieces.
        joint = [i for i, c in enumerate(chunks) if proof.ranks and not c[-1].isspace() and "\0" not in c and proof.sure(c)]
        out: list[list[int]] = [[]] * len(chunks)
        for i in set(range(len(chunks))).difference(joint):
            out[i] = self.ids(chunks[i])
        if not joint:
            return out
        some = [chunks[i] for i in joint]
        pieces = self._pattern.findall("".join(some))
        starts = np.cumsum([0, *map(len, pieces[:-1])])
        first = np.searchsorted(starts, np.cumsum([0, *map(len, some[:-1])]))  # a chunk's first piece
        found = np.array(self.merger.encode_ordinary("\0".join(pieces)), np.int64)
        part = np.flatnonzero(found == 0)  # the parting characters: ranks below 256 are bytes
        begin = np.concatenate(([0], part + 1))[first] - first  # their place once those are gone
        numbers = np.asarray(proof.rank_ids)[np.delete(found, part)].tolist()
        for i, low, high in zip(joint, begin.tolist(), [*begin[1:].tolist(), len(numbers)], strict=True):
            out[i] = numbers[low:high]
        return out

    @cached_property
    def merger(self) -> tiktoken.Encoding:
        """Merges by the proven ranks, pieces parted by the null character."""
        return tiktoken.Encoding("proven", pat_str=r"[^\x00]+|\x00", mergeable_ranks=self.proof.ranks, special_tokens={})
