"""Token ids by the tokenizers library, with a cache of words in each Python worker."""

from __future__ import annotations

import codecs
import json
import os
import re
import sys
from array import array
from collections.abc import Callable, Iterable, Iterator

from touchline.llm.workers import held

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

# Characters whose class (letter, number, space or other) is the same in every Unicode version and whose lower case is
# one character, so that the patterns below cut as the library does. A text with any other character is encoded whole.
_KNOWN = re.compile("[\t\n\r\x20-\x7e\xa0-įı-ɏ‐-‧€]*")
_LETTER = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-ɏ"
_NUMBER = "0-9\xb2\xb3\xb9\xbc-\xbe"
_SPACE = "\t\n\r\x20\xa0"
#: The published word pattern of byte-level BPE, over the characters above.
_BYTE_LEVEL = re.compile(
    f"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTER}]+| ?[{_NUMBER}]+| ?[^{_SPACE}{_LETTER}{_NUMBER}]+"
    f"|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"
)
#: That of the tokenizer with word ends, which comes after lower-casing and drops white space.
_WORD_ENDS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[{_NUMBER}]|[^{_SPACE}{_LETTER}{_NUMBER}]+")
#: Words remembered by a worker: twice this many at most (about 80 MB), as the older half goes first.
REMEMBERED = 200_000


def byte_alphabet() -> dict[str, int]:
    """The published alphabet of byte-level BPE: printable bytes stand for themselves, the rest for 256 and up."""
    same = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(same)]
    return {chr(b): b for b in same} | {chr(256 + i): b for i, b in enumerate(others)}


#: Byte -> its character in that alphabet.
_BYTES = "".join(sorted(byte_alphabet(), key=byte_alphabet().get))


class Words(dict):
    """Word -> its ids as little-endian unsigned 32-bit integers; two generations bound the memory."""

    def __init__(self, tokenizer, spelled: Callable[[str], str | None]) -> None:
        """``spelled`` gives a word as the tokenizer hands it to its model, None where only the tokenizer knows."""
        super().__init__()
        self.tokenizer, self.model, self.spelled, self.older = tokenizer, tokenizer.model, spelled, {}

    def __missing__(self, word: str) -> bytes:
        ids = self.older.get(word)
        if ids is None:
            spelling = self.spelled(word)
            if spelling is None:
                ids = packed(self.tokenizer.encode(word, add_special_tokens=False).ids)
            else:
                ids = packed([t.id for t in self.model.tokenize(spelling)])
        if len(word) <= 64:
            if len(self) >= REMEMBERED:
                self.older = dict(self)
                self.clear()
            self[word] = ids
        return ids


def packed(ids: Iterable[int]) -> bytes:
    numbers = array("I", ids)
    if sys.byteorder == "big":
        numbers.byteswap()
    return numbers.tobytes()


class Encoder:
    """Ids of whole texts, equal to ``Tokenizer.encode(text, add_special_tokens=False)``.

    Strings of special tokens in a text are ordinary text. BPE never joins what the pre-tokenizer has cut apart, so
    each word is encoded once and looked up afterwards. Which cut holds is read from the tokenizer's own file; for
    one of another make, and for texts with rare characters, the whole text goes through the library.
    """

    def __init__(self, spec: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(spec)
        self.tokenizer.encode_special_tokens = True
        self.cut, self.lowers = cut_of(json.loads(spec))
        self.words = Words(self.tokenizer, spelling_of(json.loads(spec)))

    def cuts(self, text: str) -> bool:
        """Whether the text is encoded word by word."""
        return self.cut is not None and _KNOWN.fullmatch(text) is not None

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if not self.cuts(text):
            return packed(self.tokenizer.encode(text, add_special_tokens=False).ids)
        return b"".join(map(self.words.__getitem__, self.cut.findall(text.lower() if self.lowers else text)))

    def with_end(self, texts: Iterable[str | None], end_id: int) -> Iterator[bytes]:
        end = packed([end_id])
        for text in texts:
            yield self.encode(text) + end


def cut_of(spec: dict) -> tuple[re.Pattern | None, bool]:
    """The pattern whose matches may be encoded one by one, None if the file's rules are not known here; and whether
    they are found in the lower-cased text."""
    norm, pre = spec.get("normalizer"), spec.get("pre_tokenizer") or {}
    if norm is None and pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space"):
        return _BYTE_LEVEL, False
    steps = [x.get("type") for x in (norm or {}).get("normalizers", [])]
    cuts = pre.get("pretokenizers", [])
    if steps == ["NFC", "Replace", "Lowercase"] and cuts and cuts[0].get("behavior") == "Removed" and cuts[0].get("invert"):
        if r"[^\s" in json.dumps(cuts[0]["pattern"]).replace("\\\\", "\\"):
            return _WORD_ENDS, True
    return None, False


def spelling_of(spec: dict) -> Callable[[str], str | None]:
    """How words of the tokenizer's cut are spelled for its model."""
    cut, lowers = cut_of(spec)
    if cut is not None and not lowers and byte_words(spec):
        return in_bytes
    if lowers and plain_words(spec):
        return lambda word: word if word.isascii() else None
    return lambda word: None


def in_bytes(word: str) -> str:
    """A character for each byte of the word."""
    return codecs.charmap_decode(word.encode(), "strict", _BYTES)[0]


def byte_words(spec: dict) -> bool:
    """Whether the matches of _BYTE_LEVEL go to a BPE model spelled in bytes: no added token but special ones, whose
    strings count as text."""
    return spec["model"]["type"] == "BPE" and all(x.get("special") for x in spec.get("added_tokens") or [])


def plain_words(spec: dict) -> bool:
    """Whether the matches of _WORD_ENDS go to a BPE model as they are, if they are ASCII: cut, then spelled in bytes."""
    kinds = [x.get("type") for x in spec["pre_tokenizer"].get("pretokenizers", [])]
    added = [x["content"] for x in spec.get("added_tokens") or []]
    return (kinds == ["Split", "ByteLevel"] and not spec["pre_tokenizer"]["pretokenizers"][1].get("add_prefix_space")
            and spec["model"]["type"] == "BPE" and not any(_WORD_ENDS.fullmatch(x.lower()) for x in added))


def encoder(spec: str) -> Encoder:
    """The worker's encoder for a tokenizer file; kept, as its words are worth more than the file."""
    return held(("encoder", hash(spec)), lambda: Encoder(spec))


def read_spec(path: str) -> str:
    """The tokenizer file's text, read by the driver and sent with the tasks: executors need no file."""
    with open(path, encoding="utf-8") as file:
        return file.read()
