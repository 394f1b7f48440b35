"""Token ids of texts, by the tokenizers library, inside Spark tasks."""

import os
import re
from array import array

import pyarrow as pa
import pyarrow.compute

#: Unicode's White_Space characters, which ``\s`` of the tokenizers' patterns means.
WHITE_SPACE = "\t\n\x0b\x0c\r \x85\xa0  -     　"
#: Units of text kept with their ids in a Python worker; all are dropped when there are more.
MOST_UNITS = 1_500_000
#: Longer units are not kept.
LONGEST_UNIT = 48

#: A unit whose letters, with what follows them, need no normaliser but lower case: (space, Latin-1 letters, ASCII marks).
_PLAIN = re.compile("([ \n]?)([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-@\\[-`{-~][!-~]*)?")

_encoders: dict[str, "Encoder"] = {}


def encoder(path: str) -> "Encoder":
    """The encoder of a tokenizer file; a Python worker keeps it from task to task."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


class Encoder:
    """Ids of whole texts, as ``Tokenizer.encode(text, add_special_tokens=False)`` gives them.

    Two pre-tokenizer forms never join characters over the edge between two units of text, so each distinct
    unit needs the library only once:

    * *dropped*: a normaliser that works on single characters or between white space, then a split that drops
      white space. Unit: what stands between spaces and line feeds.
    * *led*: byte-level pieces led by white space, no normaliser. Unit: white space with the word that follows.

    A plain unit (letters, then perhaps marks) goes to the library's model without its normaliser and patterns, which
    take most of the time: the patterns end a piece where letters end. Texts of other tokenizers go to the library whole.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(path, encoding="utf-8") as f:
            self.form = _form(f.read())
        self.led = re.compile(f"[{WHITE_SPACE}]*[^{WHITE_SPACE}]+|[{WHITE_SPACE}]+")
        self.kept: dict[str, bytes] = {}
        self.model = self.tokenizer.model
        # byte-level form: printable bytes stand for themselves, the others for the characters from 256 on
        own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
        self.bytes_as = {b: 256 + k for k, b in enumerate(sorted(set(range(256)) - set(own)))}
        self.space = chr(self.bytes_as[32])

    def units(self, text: str) -> list[str]:
        if self.form == "dropped":
            return text.replace("\n", " ").split(" ")
        return self.led.findall(text) if self.form == "led" else [text]

    def ids(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        units = [self.units(t) for t in texts]
        kept, new = self.kept, set().union(*units).difference(self.kept)
        plain = [] if self.form == "whole" else [m for m in map(_PLAIN.fullmatch, new) if m and (self.form == "led" or not m[1])]
        new.difference_update([m[0] for m in plain])
        words = [" " + m[2] if m[1] == " " else m[2] for m in plain]
        new.update({m[3] for m in plain if m[3]}.difference(kept), [] if "\n" in kept else ["\n"])
        rest = list(new)
        for at in range(0, len(rest), 4096):
            some = rest[at : at + 4096]
            for unit, e in zip(some, self.tokenizer.encode_batch_fast(some, add_special_tokens=False), strict=True):
                kept[unit] = array("I", e.ids).tobytes()
        for word in set(words).difference(kept):
            kept[word] = self.word(word)
        for m, word in zip(plain, words, strict=True):
            if m[0] not in kept:
                kept[m[0]] = (kept["\n"] if m[1] == "\n" else b"") + kept[word] + (kept[m[3]] if m[3] else b"")
        got = [b"".join(map(kept.__getitem__, u)) for u in units]
        for unit in {*rest, *words, *[m[0] for m in plain]}:
            if len(unit) > LONGEST_UNIT:
                del kept[unit]
        if len(kept) > MOST_UNITS:
            kept.clear()
        return got

    def word(self, word: str) -> bytes:
        word = word.lower() if self.form == "dropped" else word
        mapped = word.replace(" ", self.space) if word.isascii() else word.encode().decode("latin-1").translate(self.bytes_as)
        return array("I", [t.id for t in self.model.tokenize(mapped)]).tobytes()


def _form(text: str) -> str:
    import json

    spec = json.loads(text)
    normal, pre = spec.get("normalizer"), spec.get("pre_tokenizer") or {}
    if any(re.search(r"\s", t["content"]) or t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
        return "whole"
    if normal is None and pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space"):
        return "led"
    steps = normal["normalizers"] if normal and normal["type"] == "Sequence" else [normal] if normal else []
    local = all(s["type"] in ("NFC", "Lowercase") or s["type"] == "Replace" and s["pattern"] == {"Regex": "\\s+"} and s["content"] == " " for s in steps)
    first = pre["pretokenizers"][0] if pre.get("type") == "Sequence" else pre
    drops = first.get("type") == "Split" and first.get("behavior") == "Removed" and first.get("invert")
    return "dropped" if local and drops and r"[^\s" in first["pattern"].get("Regex", "") else "whole"


def slices(batches, most_chars: int = 4_000_000):
    """(batch, its texts) for Arrow batches cut so that few of them are in memory as Python strings at once."""
    for batch in batches:
        texts, at = batch.column("text"), 0
        sizes = pa.compute.binary_length(texts).to_pylist()
        while at < len(sizes):
            end, chars = at, 0
            while end < len(sizes) and (end == at or chars + sizes[end] <= most_chars):
                chars += sizes[end]
                end += 1
            part = batch.slice(at, end - at)
            yield part, part.column("text").to_pylist()
            at = end
