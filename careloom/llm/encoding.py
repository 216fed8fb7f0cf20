"""Token ids and counts of whole texts by public tokenizers.

A tokenizer that never joins characters across white space gives a text's ids as those of its pieces, in order.
For the two kinds of tokenizer where that is known from the file, distinct pieces are encoded in batches by the
library and remembered; any other tokenizer gets whole texts.
"""

from __future__ import annotations

import array
import json
import os
import re
from collections.abc import Iterator

from careloom.llm.runtime import SEGMENT_BYTES, segments

# bytes encoded together
BATCH_BYTES = 2 << 20
# pieces remembered by one worker; the older half is forgotten first
REMEMBERED = 1_200_000
# bytes of the words that one worker remembers and of their ids, besides the objects' own
REMEMBERED_BYTES = 64 << 20
# letters of ASCII and Latin-1, and one closing mark that is a token of its own
_LETTERS_MARK = re.compile(rb"((?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+)([.,]?)")
_SPACES_IN_A_ROW = re.compile(rb"[\x09-\x0d\x20]{2}|\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\xaa\xaf]|\xe2\x81\x9f|\xe3\x80\x80")


def _byte_letters() -> dict[int, str]:
    """The characters by which byte-level tokenizers write bytes: printed ones of Latin-1 stand for themselves, the others for those from 256 on."""
    printed = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printed]
    return {b: chr(b) for b in printed} | {b: chr(256 + k) for k, b in enumerate(others)}


class Memory:
    """Lengths by piece in two generations, so that what is in use stays and the size is bounded."""

    def __init__(self, encode, size: int = REMEMBERED):
        self.encode, self.size = encode, size
        self.known: dict = {}
        self.before: dict = {}

    def learn(self, pieces) -> dict:
        """Make all the pieces known; returns the mapping."""
        new = set(pieces).difference(self.known)
        if not new:
            return self.known
        if len(self.known) + len(new) > self.size // 2 and self.known:
            self.known, self.before = {}, self.known
            new = set(pieces)
        known, before, unseen, marked = self.known, self.before, [], []
        for piece in new:
            value = before.get(piece)
            if value is not None:
                known[piece] = value
                continue
            m = _LETTERS_MARK.fullmatch(piece)
            if m and m[2]:
                marked.append((piece, m[1], m[2]))
                piece = m[1]
                if piece in known:
                    continue
                value = before.get(piece)
                if value is not None:
                    known[piece] = value
                    continue
            unseen.append(piece)
        if unseen:
            unseen = list(dict.fromkeys(unseen))
            known.update(zip(unseen, self.encode(unseen)))
        for piece, letters, _ in marked:  # the mark is one token
            known[piece] = known[letters] + 1
        return known


def _library(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def _kind(path: str) -> str:
    """``words``: white space only separates; ``spaced``: a word takes one space before it; else ``whole``."""
    with open(path, encoding="utf-8") as f:
        made = json.load(f)
    split, normal, added = made.get("pre_tokenizer") or {}, made.get("normalizer"), made.get("added_tokens") or []
    plain = not made.get("post_processor") and all(t["content"].startswith("<|") and not t["normalized"] for t in added)
    plain = plain and not any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in added)
    if not plain or made["model"]["type"] != "BPE":
        return "whole"
    if split.get("type") == "ByteLevel" and split["use_regex"] and not split["add_prefix_space"] and normal is None:
        return "spaced"
    steps = [s["type"] for s in split.get("pretokenizers", [])]
    normals = [s["type"] for s in (normal or {}).get("normalizers", [])]
    if steps == ["Split", "ByteLevel"] and normals == ["NFC", "Replace", "Lowercase"]:
        first, second = split["pretokenizers"]
        if first["behavior"] == "Removed" and first["invert"] and r"[^\s" in first["pattern"]["Regex"] and not second["use_regex"]:
            return "words"
    return "whole"


class TextIds:
    """Ids of whole texts as little-endian unsigned integers of ``width`` bytes."""

    def __init__(self, path: str, remembered: int = REMEMBERED, remembered_bytes: int = REMEMBERED_BYTES):
        self.library, self.kind = _library(path), _kind(path)
        self.code = "H" if self.library.get_vocab_size() <= 1 << 16 else "I"
        self.width = array.array(self.code).itemsize
        self.known = _Known(self, remembered // 2, remembered_bytes // 2)

    def pack(self, ids: list[int]) -> bytes:
        return array.array(self.code, ids).tobytes()

    def encode(self, text: bytes) -> bytes:
        return self.pack(self.library.encode(text.decode("utf-8", "replace"), add_special_tokens=False).ids)

    def ids(self, text: bytes | None) -> bytes:
        """A text without tokens, and a null one, has none."""
        if not text:
            return b""
        if self.kind != "words" or b"<|" in text:
            return self.encode(text)
        return b"".join(map(self._words, segments(text)))

    def _words(self, text: bytes) -> bytes:
        known = self.known
        return b"".join([known[w] for w in text.lower().split()])


class _Known(dict):
    """Ids of words, encoded when first asked for, in two generations of bounded number and bytes.

    A full generation takes the place of the one before; what the older still knows is taken over when asked for.
    A word of letters alone is one word of the tokenizer too and goes to its model at once, spelled as byte-level
    tokenizers write bytes; with a mark behind it, it is two.
    """

    def __init__(self, ids: TextIds, words: int, size: int):
        super().__init__()
        self.model, self.encode, self.pack, self.letters = ids.library.model, ids.encode, ids.pack, _byte_letters()
        self.words, self.size, self.held, self.before = words, size, 0, {}

    def __missing__(self, word: bytes) -> bytes:
        value = self.before.get(word)
        if value is None:
            value = self._encoded(word)
        cost = len(word) + len(value)
        if cost > self.size:
            return value
        if len(self) >= self.words or self.held + cost > self.size:
            self.before, self.held = dict(self), 0
            self.clear()
        self[word] = value
        self.held += cost
        return value

    def _encoded(self, word: bytes) -> bytes:
        if word.isalpha():
            return self._letters(word.decode())
        if word[-1] in b".," and (letters := word[:-1]).isalpha():
            return (self.get(letters) or self._letters(letters.decode())) + self[word[-1:]]
        if m := _LETTERS_MARK.fullmatch(word):
            letters = self._letters(m[1].decode().lower().encode().decode("latin-1").translate(self.letters))
            return letters + self[m[2]] if m[2] else letters
        return self.encode(word)

    def _letters(self, spelled: str) -> bytes:
        return self.pack([t.id for t in self.model.tokenize(spelled)])


class TextLengths:
    """Numbers of tokens of whole texts, for a tokenizers file or a sentencepiece model."""

    def __init__(self, path: str):
        self.path, self.kind = path, "model" if path.endswith(".model") else _kind(path)
        if self.kind == "model":
            import sentencepiece

            self.library = sentencepiece.SentencePieceProcessor(model_file=path)
            return
        self.library = _library(path)
        if self.kind == "words":
            self.kind = "whole"  # its counts come by TextIds
            self.by_ids = TextIds(path)
        self.bare = Memory(lambda pieces: self._encode(pieces, ""), REMEMBERED // 8)
        self.spaced = Memory(lambda pieces: self._encode(pieces, " "))

    def _encode(self, pieces: list[bytes], before: str) -> list[int]:
        texts = [before + p.decode("utf-8", "replace") for p in pieces]
        return list(map(len, self.library.encode_batch_fast(texts, add_special_tokens=False)))

    def count(self, texts: list[bytes]) -> list[int]:
        """Counts of texts; what is encoded together is balanced by bytes."""
        if self.kind == "model":
            return [len(self.library.encode(t.decode("utf-8", "replace"))) for t in texts]
        if hasattr(self, "by_ids"):
            return [len(self.by_ids.ids(t)) // self.by_ids.width for t in texts]
        counts = [0] * len(texts)
        for run in byte_batches(self._parts(texts)):
            self._add(run, counts)
        return counts

    def _parts(self, texts: list[bytes]) -> Iterator[tuple[int, bytes, bool]]:
        """Parts of the texts, each with its text's place and whether it is encoded as it is."""
        for k, text in enumerate(texts):
            if self.kind == "whole" or b"<|" in text:
                yield k, text, True
            else:
                for part in segments(text):
                    yield k, part, bool(_SPACES_IN_A_ROW.search(part))

    def _add(self, run: list[tuple[int, bytes, bool]], counts: list[int]) -> None:
        cut = [(k, [line.split(b" ") for line in part.split(b"\n")]) for k, part, whole in run if not whole]
        bare = self.bare.learn([line[0] for _, lines in cut for line in lines])
        spaced = self.spaced.learn([w for _, lines in cut for line in lines for w in line[1:]])
        for k, lines in cut:
            # a line end between words is one token
            counts[k] += len(lines) - 1 + sum([bare[line[0]] for line in lines])
            counts[k] += sum([spaced[w] for line in lines for w in line[1:]])
        odd = [(k, part) for k, part, whole in run if whole]
        for (k, _), n in zip(odd, self._encode([part for _, part in odd], "") if odd else []):
            counts[k] += n


def byte_batches(parts, limit: int = BATCH_BYTES) -> Iterator[list]:
    """Runs of parts (second item: bytes) of about the same size; a longer part is a run of its own."""
    run, size = [], 0
    for part in parts:
        if run and size + len(part[1]) > limit:
            yield run
            run, size = [], 0
        run.append(part)
        size += len(part[1])
    if run:
        yield run


_MADE: dict = {}


def of_worker(kind, path: str):
    """One object for each worker process and file."""
    if (kind, path) not in _MADE:
        _MADE[kind, path] = kind(path)
    return _MADE[kind, path]
