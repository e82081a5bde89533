"""Exact token counts at every prefix of a text, for a BPE vocabulary with word ends.

Two facts carry it. Any run of tokens of an encoding is the encoding of the bytes it covers, and tokens
whose neighbours each encode to themselves are the encoding of the whole. So one last token stands at
the end of every prefix, and it is found from the last tokens of shorter prefixes: of the vocabulary's
entries that end there, the one that stays apart from the last token before it. The count is that
prefix's count plus one. Truncation and budgets are then look-ups in the stored counts; no text is
encoded twice.
"""

from __future__ import annotations

import json
import re
import unicodedata
from array import array
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType

VOCABULARY = "word_bpe_49k.json"
END = "</w>"
#: Code points of texts whose counts leave a task together, and of a text that are cut into pieces at once.
BATCH_CHARS, STRETCH = 1 << 22, 1 << 22
#: Pieces whose counts a task remembers, and the longest of them.
REMEMBERED, LONGEST = 400_000, 64

#: Fixed values of the vocabulary's format: pieces of a text (the rest is white space), and parts of a
#: contraction that are pieces of their own while its end is missing.
PIECES = regex.compile(r"(?:'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\p{White_Space}\p{L}\p{N}]+) ?|\p{White_Space}+", regex.V1)
LATIN_PIECES = re.compile(r"(?:'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\t-\r a-z0-9ß-öø-ÿ]+) ?|[\t-\r ]+")
BLANK = regex.compile(r"\p{White_Space}")
CONTRACTION = regex.compile(r"'(?:s|t|re|ve|m|ll|d)")
#: What may melt into the character before it: marks, and the later letters of a Korean syllable.
SEQUENCE = regex.compile(r"(?s).[\p{M}ᅡ-ᅵᆨ-ᇂ]*")


def byte_letters() -> list[str]:
    """The letter that stands for each byte: printable ones for themselves, the others from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


class Remembered(dict):
    """Results by piece, made when missing. Holds ``most`` of them, and the ``most`` before those."""

    def __init__(self, make, most: int):
        self.make, self.most, self.older = make, most, {}

    def __missing__(self, piece: str) -> bytes:
        held = self.older.get(piece) or self.make(piece)
        if len(piece) <= LONGEST:
            if len(self) >= self.most:
                self.older = dict(self)
                self.clear()
            self[piece] = held
        return held


class PrefixCounter:
    """Counts of one vocabulary file. Holds no more than its tables and ``REMEMBERED`` pieces and pairs,
    twice. Tokens are numbered by the order in which merges make them, letters first."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.library = Tokenizer.from_file(path)
        model = spec["model"]
        merges = [tuple(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]
        letters = byte_letters()
        names = [*letters, *(x + END for x in letters), *(a + b for a, b in merges)]
        if model["type"] != "BPE" or model.get("end_of_word_suffix") != END or len({*names}) != len(names) or not model["vocab"].keys() >= {*names}:
            raise ValueError(f"{path} is no BPE vocabulary of bytes with word ends")
        self.number = {x: i for i, x in enumerate(names)}
        self.parts = [(i, i) for i in range(512)] + [(self.number[a], self.number[b]) for a, b in merges]
        self.joined = {self.key(*self.parts[i]): i for i in range(512, len(names))}
        self.table = str.maketrans({i: x for i, x in enumerate(letters)})
        stems: dict[str, list[int]] = {}
        for name, i in self.number.items():
            if self.whole(i):
                ended = name.endswith(END) and len(name) > len(END)
                stems.setdefault(name[: -len(END)] if ended else name, [-1, -1])[ended] = i
        self.stems = ahocorasick.Automaton()
        for stem, (inner, final) in stems.items():
            self.stems.add_word(stem, (inner, final, len(stem)))
        self.stems.make_automaton()
        special = sorted((t["content"] for t in spec["added_tokens"] if t["special"]), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.apart: dict[int, bool] = {}
        self.known: dict[str, int] = {}
        self.pieces = Remembered(self.steps, REMEMBERED)
        self.cores = Remembered(self.counted, REMEMBERED)

    # -- one piece

    @staticmethod
    def key(before: int, token: int) -> int:
        return before << 24 | token

    def whole(self, token: int) -> bool:
        """Whether the token's own symbols, merged anew, give it: its two parts are whole, and nothing
        at their border merges before they do."""
        if token < 512:
            return True
        a, b = self.parts[token]
        return self.whole(a) and self.whole(b) and self.stays(a, b, token)

    def stays(self, before: int, token: int, until: int | None = None) -> bool:
        """Whether no merge joins the two tokens (before the merge ``until``). The tokens are taken apart
        again, the later merge first, at equal ones the right; a pair at the border that has a merge of
        its own joins if that one comes before the merges that the pair's tokens went into."""
        a, b, limit = before, token, until if until is not None else len(self.parts)
        while True:
            made = self.joined.get(self.key(a, b))
            if made is not None and made < limit:
                return False
            if a < 512 and b < 512:
                return True
            if a > b:
                limit, a = min(limit, a), self.parts[a][1]
            else:
                limit, b = min(limit, b + 1), self.parts[b][0]

    def follows(self, key: int) -> bool:
        if len(self.apart) >= 2 * REMEMBERED:
            self.apart.clear()
        held = self.apart[key] = self.stays(key >> 24, key & 0xFFFFFF)
        return held

    def counted(self, piece: str) -> bytes:
        """How the count changes with each code point of one piece, each prefix taken as a text of its own, as int32."""
        if CONTRACTION.fullmatch(piece):
            parts = [[piece[:1], piece[1:n]] for n in range(1, len(piece))]
            counts = [sum(self.ends(p)[-1] for p in x if p) for x in parts] + [self.ends(piece)[-1]]
        else:
            counts = self.ends(piece)
        return array("i", map(int.__sub__, counts, [0, *counts[:-1]])).tobytes()

    def ends(self, piece: str) -> list[int]:
        """The dynamic programme over the bytes of a piece. ``last`` and ``count`` are of prefixes
        that go on; the token that ends a prefix carries the word end and is found from them."""
        plain = piece.isascii() and piece.isprintable()
        letters = piece if plain else piece.encode().decode("latin-1").translate(self.table)
        room = [0] if len(letters) < 1 << 16 else array("i", [0])
        last, count, out = room * (len(letters) + 1), room * (len(letters) + 1), room * (len(letters) + 1)
        known, follows = self.apart.get, self.follows
        for end, (inner, final, size) in self.stems.iter(letters):
            at = end + 1
            j = at - size
            if inner >= 0 and not count[at]:
                if j:
                    key = last[j] << 24 | inner
                    stays = known(key)
                    if stays is None:
                        stays = follows(key)
                if not j or stays:
                    last[at] = inner
                    count[at] = count[j] + 1
            if final >= 0 and not out[at]:
                if j:
                    key = last[j] << 24 | final
                    stays = known(key)
                    if stays is None:
                        stays = follows(key)
                if not j or stays:
                    out[at] = count[j] + 1
        if plain:
            return list(out[1:])
        ends, at = [], 0
        for c in piece:
            at += len(c.encode())
            ends.append(out[at])
        return ends

    def steps(self, piece: str) -> bytes:
        """How the count changes with each code point of a piece and the blank behind it, as int32."""
        core = piece.rstrip(" ")
        if not core or core[0].isspace() and BLANK.match(core):
            return bytes(4 * len(piece))
        return self.cores[core] + bytes(4 * (len(piece) - len(core)))

    # -- one text

    def normalised(self, text: str) -> str:
        return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()  # letter by letter: no final sigma

    def reading(self, c: str) -> int:
        """0 if the tables here and the library's, which may be of another Unicode version, read ``c``
        otherwise; else 2 for what ``LATIN_PIECES`` reads rightly, and 1 for the rest."""
        if c not in self.known:
            own = self.normalised(c)
            same, simple = own == self.library.normalizer.normalize_str(c) or bool(BLANK.fullmatch(c)), True
            for x in own if same else "":
                kind = "letter" if regex.match(r"\p{L}", x) else "number" if regex.match(r"\p{N}", x) else "space" if BLANK.match(x) else "other"
                cuts = tuple(len(self.library.pre_tokenizer.pre_tokenize_str(f"{e}{x}{e}")) for e in "a!")
                same = same and cuts == {"letter": (1, 3), "number": (3, 3), "space": (2, 2), "other": (3, 1)}[kind]
                simple = simple and (x.isascii() or kind == ("letter" if LATIN_PIECES.match(x + "a").end() == 2 else "other"))
            self.known[c] = same + (same and simple)
        return self.known[c]

    def prefix_counts(self, text: str) -> np.ndarray:
        """Element p - 1 is the number of tokens of the first p code points."""
        out, base, at = [], 0, 0
        while at < len(text):
            m = self.special.search(text, at) if self.special else None
            end = m.start() if m else len(text)
            # while the last character of a special string is missing, its beginning is ordinary text
            counts = self.ordinary(text[at : m.end() - 1] if m else text[at:]) + base
            out.append(counts)
            if m:
                base += 1 + (int(counts[end - at - 1]) - base if end > at else 0)
                out.append(np.array([base], np.int64))
            at = m.end() if m else len(text)
        return np.concatenate(out) if out else np.zeros(0, np.int64)

    def ordinary(self, text: str) -> np.ndarray:
        if text.isascii():
            return self.by_letter(text.lower(), 2)
        agreed = min(map(self.reading, set(text)))
        whole = self.normalised(text)
        if agreed and len(whole) == len(text) and unicodedata.is_normalized("NFC", text):
            return self.by_letter(whole, agreed)
        parts = SEQUENCE.findall(text)
        levelled = [self.normalised(p) if agreed else self.library.normalizer.normalize_str(p) for p in parts]
        counts = self.by_letter("".join(levelled), agreed)
        ends = np.cumsum([len(x) for x in levelled])
        return np.repeat(np.concatenate([[0], counts])[ends], [len(p) for p in parts])

    def by_letter(self, text: str, agreed: int) -> np.ndarray:
        """Counts at every code point of a normalised text."""
        steps = []
        at = 0
        while at < len(text):
            end = at + STRETCH
            if end < len(text):  # pieces never hold white space, so it is a safe place to cut
                m = regex.search(r"\p{White_Space}", text, pos=end)
                end = m.start() if m else len(text)
            steps.append(np.frombuffer(b"".join(map(self.pieces.__getitem__, self.cut(text[at:end], agreed))), np.int32))
            at = end
        return np.cumsum(np.concatenate(steps), dtype=np.int64) if steps else np.zeros(0, np.int64)

    def cut(self, text: str, agreed: int) -> list[str]:
        if agreed:
            return (LATIN_PIECES if agreed > 1 else PIECES).findall(text)
        out, at = [], 0
        for _, (start, end) in self.library.pre_tokenizer.pre_tokenize_str(text):
            out += [text[at:start]] * (start > at) + [text[start:end]]
            at = end
        return out + [text[at:]] * (at < len(text))


@lru_cache(maxsize=2)
def counter_of(path: str) -> PrefixCounter:
    """One for each Python process: what a task has learnt about pieces helps the next one there."""
    return PrefixCounter(path)


def prefix_counts(docs: DataFrame, path: str, text_col: str = "text", to: str = "prefix_tokens") -> DataFrame:
    """``docs`` with the array ``to``: its element p is the number of tokens of the first p code points
    of the text, as the tokenizers library gives them for the file ``path`` (a BPE vocabulary with word
    ends, on every executor) without added tokens, special strings read as the library reads them.

    A prefix that ends inside a sequence of combining characters, or of the letters of one Korean
    syllable, counts as if the sequence were whole. A null or empty text has an empty array. Rows, their
    repeats and their other columns stay as they are; a column named ``to`` is replaced. Each row is read
    on its own, without a shuffle, in time proportional to its length, one word without spaces included.
    Counts leave a task by ``BATCH_CHARS`` code points; a longer text goes alone. Where the library reads
    a character otherwise than the tables here (another Unicode version), it cuts that text itself.
    """
    kept = [c for c in docs.columns if c.lower() != to.lower()]
    place = [c.lower() for c in kept].index(text_col.lower())
    rows = docs.select(*[f"`{c}`" for c in kept]).toDF(*map(str, range(len(kept))))
    schema = StructType([*rows.schema.fields, StructField("counts", ArrayType(IntegerType()))])

    def count(batches):
        counter = counter_of(path)
        for batch in batches:
            texts = pc.fill_null(pc.cast(batch.column(place), pa.string()), "")
            sizes = pc.utf8_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
            group = np.cumsum(sizes) // BATCH_CHARS
            starts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(sizes)]
            for a, b in zip(starts, starts[1:], strict=False):
                found = [counter.prefix_counts(t) for t in texts.slice(a, b - a).to_pylist()]
                offsets = pa.array(np.cumsum([0, *map(len, found)]).astype(np.int32))
                values = pa.array(np.concatenate([np.zeros(0, np.int64), *found]).astype(np.int32))
                lists = pa.ListArray.from_arrays(offsets, values)
                yield pa.RecordBatch.from_arrays([c.slice(a, b - a) for c in batch.columns] + [lists], names=schema.names)

    return rows.mapInArrow(count, schema).toDF(*kept, to)


def tokens_of(counts: Column, chars: Column | int) -> Column:
    """Tokens of the first ``chars`` code points (0 for none; beyond the end, those of the whole text)."""
    n = F.least(F.lit(chars) if isinstance(chars, int) else chars, F.size(counts))
    return F.when(n <= 0, F.lit(0)).otherwise(F.get(counts, n - 1)).cast("long")


def longest_prefix(counts: Column, budget: Column | int) -> Column:
    """Code points of the longest prefix with at most ``budget`` tokens. Counts may fall again as a word
    goes on, so the last fitting place is taken, not the first that is too long."""
    most = F.lit(budget) if isinstance(budget, int) else budget
    return F.coalesce(F.array_max(F.transform(counts, lambda n, i: F.when(n <= most, i + 1))), F.lit(0)).cast("long")


def truncated(text: Column, counts: Column, budget: Column | int) -> Column:
    """The longest prefix of ``text`` with at most ``budget`` tokens."""
    return F.substring(F.coalesce(text, F.lit("")), F.lit(1), longest_prefix(counts, budget).cast("int"))


def op11_token_counts(spark, sf_dir, limit: int = 2048):
    import public_tokenizers

    from .common import table, whole_text

    docs = table(spark, sf_dir, "documents").select("doc_id", whole_text().alias("text"))
    counted = prefix_counts(docs, public_tokenizers.path(VOCABULARY))
    tokens = tokens_of(F.col("prefix_tokens"), F.size("prefix_tokens"))
    return counted.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), tokens.alias("n_tokens")).withColumn("over_limit", F.col("n_tokens") > limit)
