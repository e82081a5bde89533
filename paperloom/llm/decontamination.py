"""Benchmark decontamination by template canonicalisation.

Texts become sequences of tokens in which numbers, names and units are typed placeholders,
so that a question with other parameters keeps its template. Windows of consecutive template
tokens are hash-joined between documents and benchmark items. A run of windows that covers
enough of an item is a leak if its slots are consistent: one value of the item always maps
to one value of the document. A window without any word has no template, so it counts by its
values.
"""

from __future__ import annotations

import bisect
import math
import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut_lineage

WINDOW = 8
#: Least and most bits (as powers of two) of the filter that documents' windows pass before the join;
#: between them it has 64 for each window of an item, so that one in 1,000 others passes.
FILTER_BITS = (22, 28)
#: Most pairs of positions that are listed to find the alignments of one document and one item; more are counted by transforms.
LISTED_PAIRS = 1 << 20
_TOKEN = re.compile(r"[0-9]+(?:[.,][0-9]+)*|[^\W\d_]+|[.!?]")
UNITS = {
    "mm", "cm", "m", "km", "inch", "inches", "feet", "ft", "mile", "miles", "mg", "g", "kg", "lb", "lbs", "ounce", "ounces",
    "ml", "l", "liter", "liters", "litre", "litres", "second", "seconds", "minute", "minutes", "hour", "hours", "day", "days",
    "week", "weeks", "month", "months", "year", "years", "dollar", "dollars", "euro", "euros", "cent", "cents", "percent",
    "mph", "kmh", "watt", "watts", "volt", "volts", "degree", "degrees",
}
NUMBER, NAME, UNIT = 1, 2, 3


class Vocabulary(dict):
    """Raw tokens to numbers, and what is fixed for each: template code of its lower case, kind."""

    END, CAPITALISED = 8, 9

    def __init__(self):
        super().__init__()
        self.raw: list[str] = []
        self.code, self.kind = np.zeros(1 << 18, np.uint64), np.zeros(1 << 18, np.int8)

    def __missing__(self, raw: str) -> int:
        n = self[raw] = len(self.raw)
        self.raw.append(raw)
        return n

    def numbers(self, raw: list[str]) -> np.ndarray:
        """The tokens' numbers. Codes and kinds of new ones are found for all of them at once."""
        known = len(self.raw)
        out = np.fromiter(map(self.__getitem__, raw), np.int64, len(raw))
        if new := self.raw[known:]:
            n = len(self.raw)
            while n > len(self.code):
                self.code, self.kind = np.concatenate([self.code, np.zeros_like(self.code)]), np.concatenate([self.kind, np.zeros_like(self.kind)])
            lines = "\n".join(new).lower()  # no token has a line break
            self.kind[known:n] = list(map(self.kind_of, new, lines.split("\n")))
            self.code[known:n] = list(map(xxhash.xxh64_intdigest, lines.encode("utf-8", "surrogatepass").split(b"\n")))
        return out

    def kind_of(self, raw: str, low: str) -> int:
        if low in UNITS:
            return UNIT
        if (c := raw[0]) > "?":  # past digits and sentence marks
            return self.CAPITALISED if raw != low and c != low[0] and raw[1:] == low[1:] and len(raw) > 1 else 0
        return NUMBER if "0" <= c <= "9" else self.END

    def low(self, n: int) -> str:
        return self.raw[n].lower()


_WORDS = Vocabulary()
#: A worker's vocabulary starts anew beyond this size.
_MOST_WORDS = 250_000
#: Texts of so many characters, at least one, are read together.
_CHARACTERS = 1 << 17


MARK = "\x1f"


@dataclass
class Template:
    """Tokens of one text without sentence marks: their numbers in ``words``; and where each token
    or slot begins, template codes and kinds. A run of one kind of slot is one slot."""

    words: Vocabulary
    numbers: np.ndarray
    starts: np.ndarray
    codes: np.ndarray
    kinds: np.ndarray

    def value(self, i: int) -> str:
        end = self.starts[i + 1] if i + 1 < len(self.starts) else len(self.numbers)
        return " ".join([self.words.low(n) for n in self.numbers[self.starts[i] : end].tolist()])

    def slots(self, at: int, width: int) -> str:
        """The values of the slots among ``width`` tokens, nothing for other tokens, with marks between."""
        return MARK.join([self.value(at + i) if k else "" for i, k in enumerate(self.kinds[at : at + width].tolist())])

    def tokens(self) -> list[str]:
        return [self.value(i) for i in range(len(self.starts))]

    def hashes(self, width: int) -> np.ndarray:
        """``window_hashes``; windows of slots alone are hashed by what stands in the slots."""
        out = window_hashes(self.codes, width)
        if not len(out):
            return out
        words = np.concatenate([[0], np.cumsum(self.kinds == 0)])
        width = min(width, len(self.codes))
        bare = np.flatnonzero(words[width:] == words[:-width])
        if len(bare):
            within = np.arange(len(self.numbers)) - np.repeat(self.starts, np.diff(self.starts, append=len(self.numbers)))
            with np.errstate(over="ignore"):
                values = np.add.reduceat(self.words.code[self.numbers] * (2 * within + 1).astype(np.uint64), self.starts)
            out[bare] = window_hashes(values, width)[bare]
        return out


def _template(numbers: np.ndarray, kinds: np.ndarray, texts: np.ndarray) -> Template:
    begins = np.ones(len(kinds), dtype=bool)
    begins[1:] = (kinds[1:] == 0) | (kinds[1:] != kinds[:-1]) | (texts[1:] != texts[:-1])
    starts = np.flatnonzero(begins)
    kinds = kinds[starts]
    codes = np.where(kinds > 0, kinds.astype(np.uint64), _WORDS.code[numbers[starts]])
    return Template(_WORDS, numbers, starts, codes, kinds)


def readings(text: str | None) -> list[Template]:
    """A text as tokens in lower case, and the kind of each: 0 a word, else ``NUMBER``, ``NAME``
    (capitalised, but not at the start of a sentence) or ``UNIT``. Codes of slots depend on the
    kind alone. If capitalised tokens start sentences, a second template has these as names."""
    return joint_readings([text])[0]


def joint_readings(texts: list[str | None]) -> tuple[list[Template], np.ndarray]:
    """The ``readings`` of several texts, one after the other in one template, and the text of each token."""
    global _WORDS
    if len(_WORDS) > _MOST_WORDS:
        _WORDS = Vocabulary()
    tokens = [_TOKEN.findall(t or "") for t in texts]
    numbers = _WORDS.numbers([x for own in tokens for x in own] if len(tokens) > 1 else tokens[0])
    text = np.repeat(np.arange(len(texts)), [len(own) for own in tokens])
    kinds = _WORDS.kind[numbers]
    ends = kinds == Vocabulary.END
    first = np.ones(len(numbers), dtype=bool)
    first[1:] = ends[:-1] | (text[1:] != text[:-1])
    capital = kinds == Vocabulary.CAPITALISED
    named = np.where(capital, NAME, kinds)[~ends]
    kinds[capital] = np.where(first[capital], 0, NAME)
    numbers, kinds, text = numbers[~ends], kinds[~ends], text[~ends]
    plain = _template(numbers, kinds, text)
    return [plain] if np.array_equal(kinds, named) else [plain, _template(numbers, named, text)], text


def joint_windows(texts: list[str | None], widths: list[int], width: int, passing):
    """(text, window width, hash, position, slots) of all windows within one text whose hashes' indices ``passing``
    gives, as ``read_windows`` has them for each text: later readings only give windows of ``width`` tokens."""
    own, text = joint_readings(texts)
    plain = own[0]
    whose = text[plain.starts]
    begin = np.searchsorted(whose, np.arange(len(texts)))
    for w in widths:
        if len(plain.codes) < w:
            continue
        for template, hashes, places, at in read_windows(own if w == width else own[:1], w):
            there = text[template.starts]
            kept = passing(hashes)
            of = there[at[kept]]
            # inside one text, in this reading and in the first, whose positions count
            kept = kept[(there[at[kept] + w - 1] == of) & (whose[places[kept] + w - 1] == of)]
            for i in kept.tolist():
                t = int(there[at[i]])
                yield t, w, int(hashes[i]), int(places[i] - begin[t]), template.slots(int(at[i]), w)


def canonical(text: str | None) -> Template:
    """The first of the ``readings``: a token at the start of a sentence is a word."""
    return readings(text)[0]


def read_windows(own: list[Template], width: int):
    """(template, hashes, positions, indices) of each reading's windows. Positions count in the
    first reading; a later one only gives full windows, and those that the first lacks."""
    plain = own[0]
    hashes = plain.hashes(width)
    at = np.arange(len(hashes))
    yield plain, hashes, at, at
    for other in own[1:]:
        if len(other.codes) < width:
            continue
        more = other.hashes(width)
        place = np.searchsorted(plain.starts, other.starts[: len(more)])
        known = np.zeros(len(plain.starts), dtype=np.int64)
        known[: len(hashes)] = hashes
        new = np.flatnonzero((more != known[place]) & (place < len(hashes)))
        yield other, more[new], place[new], new


def window_hashes(codes: np.ndarray, width: int) -> np.ndarray:
    """One signed 64-bit hash for each window of ``width`` codes (of all, if there are fewer)."""
    n = len(codes)
    if n == 0:
        return np.empty(0, dtype=np.int64)
    width = min(width, n)
    out = np.full(n - width + 1, width, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for i in range(width):
            out = (out ^ codes[i : n - width + 1 + i]) * np.uint64(0x9E3779B97F4A7C15)
            out ^= out >> np.uint64(29)
    return out.view(np.int64)


def consistency(theirs: np.ndarray, ours: np.ndarray) -> float:
    """Share of the slots whose item value maps to the document value seen most for it, or the
    other way if that is less; 1.0 without slots. Values are numbers."""
    if not len(theirs):
        return 1.0

    def most(a: np.ndarray, b: np.ndarray) -> int:
        order = np.lexsort((b, a))
        a, b = a[order], b[order]
        pair = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])]))
        counts = np.diff(pair, append=len(a))
        value = np.flatnonzero(np.concatenate([[True], a[pair][1:] != a[pair][:-1]]))
        return int(np.maximum.reduceat(counts, value).sum())

    return min(most(theirs, ours), most(ours, theirs)) / len(theirs)


def _in_order(cells: list[tuple[int, int]]) -> list[int]:
    """Indices of a longest run of (item position, document position) that rises in both."""
    tails, last, before = [], [], [-1] * len(cells)
    for k in sorted(range(len(cells)), key=lambda k: cells[k]):
        j = bisect.bisect_left(tails, cells[k][1])
        before[k] = last[j - 1] if j else -1
        tails[j:j + 1], last[j:j + 1] = [cells[k][1]], [k]
    out, k = [], last[-1] if last else -1
    while k >= 0:
        out.append(k)
        k = before[k]
    return out[::-1]


class Pair:
    """The windows that one document and one item share. ``rows`` are (positions in the item,
    slots there, positions in the document, slots there), one for each shared hash."""

    def __init__(self, rows: list, width: int):
        self.width = width
        values: dict[str, int] = {"": 0}

        def coded(slots) -> list[list[int]]:
            return [[values.setdefault(v, len(values)) for v in x.split(MARK)] for x in slots]

        self.rows = [(np.asarray(i), np.asarray(d)) for i, _, d, _ in rows]
        self.ipos = np.concatenate([i for i, _ in self.rows])
        self.code = np.repeat(np.arange(len(rows)), [len(i) for i, _ in self.rows])
        self.islots = np.array([x for _, own, _, _ in rows for x in coded(own)], dtype=np.int64).reshape(len(self.ipos), -1)
        dpos = np.concatenate([d for _, d in self.rows])
        dcode = np.repeat(np.arange(len(rows)), [len(d) for _, d in self.rows])
        self.dslots = np.array([x for *_, own in rows for x in coded(own)], dtype=np.int64).reshape(len(dpos), -1)
        # a place of the document has at most two windows, one for each reading of the text
        self.last = int(dpos.max())
        self.at = np.full((2, self.last + 1), -1, dtype=np.int64)
        order = np.argsort(dpos, kind="stable")
        again = np.concatenate([[False], dpos[order][1:] == dpos[order][:-1]])
        self.at[again.astype(int), dpos[order]] = order
        self.dcode = np.append(dcode, -1)

    def shifts(self) -> np.ndarray:
        """All shifts (position in the document less that in the item) that may align windows."""
        if sum(len(i) * len(d) for i, d in self.rows) <= LISTED_PAIRS:
            return np.unique(np.concatenate([(d[None, :] - i[:, None]).ravel() for i, d in self.rows]))
        last = int(self.ipos.max())
        size = 1 << (self.last + last + 1).bit_length()
        seen = np.zeros(size, dtype=bool)
        for i, d in self.rows:
            if len(i) * len(d) <= size:
                seen[(d[None, :] - i[:, None]).ravel() + last] = True
            else:
                x, y = np.zeros(size), np.zeros(size)
                x[last - i], y[d] = 1, 1
                seen |= np.fft.irfft(np.fft.rfft(x) * np.fft.rfft(y), size) > 0.5
        return np.flatnonzero(seen) - last

    def along(self, shift: int) -> tuple[np.ndarray, np.ndarray]:
        """Item windows found along one alignment, each place once: indices of theirs and of the document's."""
        place = self.ipos + shift
        inside = (place >= 0) & (place <= self.last)
        place = np.where(inside, place, 0)
        one, two = self.at[0, place], self.at[1, place]
        first, second = inside & (self.dcode[one] == self.code), inside & (self.dcode[two] == self.code)
        mine = np.flatnonzero(first | second)
        _, once = np.unique(self.ipos[mine], return_index=True)
        mine = mine[once]
        return mine, np.where(first[mine], one[mine], two[mine])

    def judged(self, mine: np.ndarray, other: np.ndarray) -> tuple[int, float]:
        """Number of slots in these windows and their consistency; a place counts once."""
        a, b = self.islots[mine].ravel(), self.dslots[other].ravel()
        place = (self.ipos[mine][:, None] + np.arange(self.islots.shape[1])).ravel()
        slot = np.flatnonzero((a > 0) | (b > 0))
        _, once = np.unique(place[slot], return_index=True)
        slot = slot[once]
        return len(slot), consistency(a[slot], b[slot])

    def best(self, need: int, least: float) -> tuple[int, int, float] | None:
        """(windows, slots, consistency) of the alignment with the most windows, at least ``need``, whose slots
        are consistent; at equals the first. Alignments whose shifts follow each other by at most the width
        count as one as well: of each item window the place along the alignment that has most, in order."""
        shifts = self.shifts()
        found = np.array([len(self.along(s)[0]) for s in shifts.tolist()])
        shifts, found = shifts[found > 0], found[found > 0]
        out = None
        for k in np.lexsort((shifts, -found)).tolist():
            if found[k] < need:
                break
            slots, share = self.judged(*self.along(int(shifts[k])))
            if share >= least:
                out = (int(found[k]), slots, share)
                break
        starts = np.flatnonzero(np.diff(shifts, prepend=-(10**12)) > self.width).tolist()
        for low, high in zip(starts, [*starts[1:], len(shifts)], strict=True):
            if high - low > 1 and found[low:high].sum() >= max(need, (out[0] if out else 0) + 1):
                mine, other = self._chained(shifts[low:high], found[low:high])
                if len(mine) >= need and (out is None or len(mine) > out[0]):
                    slots, share = self.judged(mine, other)
                    if share >= least:
                        out = (len(mine), slots, share)
        return out

    def _chained(self, shifts: np.ndarray, found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        taken = np.zeros(int(self.ipos.max()) + 1, dtype=bool)
        left = len(np.unique(self.ipos))
        mine, other, moved = [], [], []
        for k in np.lexsort((-shifts, -found)).tolist():
            a, b = self.along(int(shifts[k]))
            new = ~taken[self.ipos[a]]
            taken[self.ipos[a]] = True
            mine.append(a[new])
            other.append(b[new])
            moved.append(np.full(int(new.sum()), shifts[k]))
            left -= int(new.sum())
            if not left:
                break
        a, b, s = np.concatenate(mine), np.concatenate(other), np.concatenate(moved)
        order = _in_order(list(zip(self.ipos[a].tolist(), (self.ipos[a] + s).tolist(), strict=True)))
        return a[order], b[order]


def _places(hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The two places of each hash in a filter of ``2**bits`` bits: its first and its last bits."""
    return (hashes.view(np.uint64) >> np.uint64(64 - bits)).astype(np.int64), hashes & ((1 << bits) - 1)


def _passing(hashes: np.ndarray, packed: np.ndarray, bits: int) -> np.ndarray:
    """Indices of the hashes that the filter may hold."""
    one, two = _places(hashes, bits)
    held = lambda at: (packed[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).astype(bool)
    kept = np.flatnonzero(held(one))
    return kept[held(two[kept])]


def _grouped(found) -> list[tuple[int, list[int], list[str]]]:
    """(hash, positions, slots) once for each hash, from (hash, position, slots); a position once."""
    own: dict[int, dict[int, str]] = {}
    for h, p, slots in found:
        own.setdefault(h, {}).setdefault(p, slots)
    return [(h, list(x), list(x.values())) for h, x in own.items()]


def _lots(texts: pd.Series):
    """(from, to) of runs of texts that have ``_CHARACTERS`` in all, the last text counted in."""
    low = n = 0
    for i, t in enumerate(texts):
        n += len(t)
        if n >= _CHARACTERS:
            yield low, i + 1
            low, n = i + 1, 0
    if low < len(texts):
        yield low, len(texts)


def _text_key(text: str) -> int:
    return int(np.uint64(xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass"))).view(np.int64))


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    least_share: float = 0.3,
    least_consistency: float = 0.8,
    width: int = WINDOW,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    filter_bits: int | None = None,
) -> DataFrame:
    """One row for each document and item that the document leaks: id, item, share (of the
    item's template windows found along one alignment, or in order along alignments whose
    shifts follow each other by at most ``width`` positions), n_windows, n_slots, consistency.

    An item of fewer than ``width`` tokens has one window, all of it, and is sought by its own
    width. Null and empty texts have no windows. Rows with a null id or a null item id take no
    part. Repeated rows of a document or an item give one row; several texts of one id are each
    compared, and the largest share counts. Empty tables give no rows; other columns are
    ignored. Texts are cut into windows whole.

    Item windows form a table that documents' windows are hash-joined to, both with one row for
    each text and hash, so that a window that repeats in a text costs one row. Before the join
    each document drops the windows that a bit filter excludes; the filter is merged from the
    item windows, is sized by their number within ``FILTER_BITS`` (at most 32 MB) and only
    excludes windows that no item has. The join proposes pairs by each item's rarest windows:
    a leak has so many of an item's windows that it holds one of those, so a window that many
    items and many documents share proposes nothing by itself. Positions and slots are fetched
    for the proposed pairs alone, and stream through a task pair by pair.
    """
    item_kind, doc_kind = benchmark.schema[item_col].dataType.simpleString(), docs.schema[id_col].dataType.simpleString()

    def item_windows(frames):
        for f in frames:
            out = []
            for item, text in zip(f["_item"], f["_t"], strict=True):
                own = readings(text)
                w = min(width, len(own[0].codes))
                n = len(own[0].codes) - w + 1
                found = (
                    (h, p, t.slots(i, w)) for t, hashes, places, at in read_windows(own, width) for h, p, i in zip(hashes.tolist(), places.tolist(), at.tolist(), strict=True)
                )
                key = _text_key(text)
                out += [(item, key, h, w, n, at, slots) for h, at, slots in _grouped(found)]
            yield pd.DataFrame(out, columns=["_item", "_ik", "_h", "_w", "_n", "_iat", "_islots"])

    items = benchmark.where(F.col(item_col).isNotNull()).select(
        F.col(item_col).alias("_item"), F.coalesce(F.col(item_text_col).cast("string"), F.lit("")).alias("_t")
    )
    schema = f"_item {item_kind}, _ik long, _h long, _w int, _n int, _iat array<int>, _islots array<string>"
    known = items.distinct().mapInPandas(item_windows, schema)
    # an item's rows in order of how many items have them: of the last ceil(share * n) - 1 entries one alone proves nothing
    often = F.count(F.lit(1)).over(Window.partitionBy("_h", "_w"))
    rarest = Window.partitionBy("_item", "_ik").orderBy("_often", "_h").rowsBetween(Window.unboundedPreceding, -1)
    entries = F.sum(F.size("_iat")).over(Window.partitionBy("_item", "_ik"))
    known = known.withColumn("_need", F.greatest(F.lit(1), F.ceil(F.col("_n") * F.lit(least_share))).cast("int")).withColumn("_often", often)
    before = F.coalesce(F.sum(F.size("_iat")).over(rarest), F.lit(0))
    known = cut_lineage(known.withColumn("_proposes", before <= entries - F.col("_need")).drop("_often"))
    if filter_bits is None:
        filter_bits = min(max(FILTER_BITS[0], math.ceil(math.log2(64 * known.count() + 1))), FILTER_BITS[1])

    def bits(frames):
        merged = np.zeros(1 << filter_bits, dtype=bool)
        widths = 0
        for f in frames:
            if len(f):
                for at in _places(f["_h"].to_numpy(np.int64), filter_bits):
                    merged[at] = True
                for w in f["_w"].unique().tolist():
                    widths |= 1 << int(w)
        yield pd.DataFrame({"_bits": [np.packbits(merged).tobytes()], "_widths": [widths]})

    mask, widths = np.zeros(1 << (filter_bits - 3), dtype=np.uint8), 0
    for r in known.select("_h", "_w").coalesce(8).mapInPandas(bits, "_bits binary, _widths long").toLocalIterator():
        mask |= np.frombuffer(r["_bits"], dtype=np.uint8)
        widths |= r["_widths"]
    held = docs.sparkSession.sparkContext.broadcast((mask.tobytes(), [w for w in range(1, width + 1) if widths >> w & 1]))

    def doc_windows(frames):
        packed, sizes = held.value
        packed = np.frombuffer(packed, dtype=np.uint8)

        def passing(hashes: np.ndarray) -> np.ndarray:
            return _passing(hashes, packed, filter_bits)

        for f in frames:
            out = []
            for low, high in _lots(f["_t"]):
                found: dict[tuple[int, int], list] = {}
                for t, w, *window in joint_windows(f["_t"].iloc[low:high].tolist(), sizes, width, passing):
                    found.setdefault((low + t, w), []).append(window)
                for (i, w), own in found.items():
                    doc, key = f["_doc"].iloc[i], _text_key(f["_t"].iloc[i])
                    out += [(doc, key, h, w, at, slots) for h, at, slots in _grouped(own)]
            yield pd.DataFrame(out, columns=["_doc", "_dk", "_h", "_w", "_dat", "_dslots"])

    texts = docs.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("_doc"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_t")
    )
    found = cut_lineage(texts.mapInPandas(doc_windows, f"_doc {doc_kind}, _dk long, _h long, _w int, _dat array<int>, _dslots array<string>"))
    pair = ["_doc", "_dk", "_item", "_ik"]
    proposed = found.select("_doc", "_dk", "_h", "_w").join(known.where("_proposes").select("_item", "_ik", "_h", "_w"), ["_h", "_w"]).select(*pair).distinct()
    shared = proposed.join(known, ["_item", "_ik"]).join(found.dropDuplicates(["_doc", "_dk", "_h", "_w"]), ["_doc", "_dk", "_h", "_w"])
    enough = F.sum(F.size("_iat")).over(Window.partitionBy(*pair)) >= F.col("_need")
    cells = ["_w", "_n", "_need", "_iat", "_islots", "_dat", "_dslots"]
    streamed = shared.select(*pair, *cells, enough.alias("_enough")).where("_enough").drop("_enough").sortWithinPartitions(*pair)

    def judge(frames):
        own, rows, size = None, [], (1, 1, 1)

        def done():
            w, n, need = size
            got = Pair(rows, w).best(need, least_consistency)
            return [] if got is None else [(own[0], own[2], got[0] / n, *got)]

        for f in frames:
            out = []
            for doc, dk, item, ik, w, n, need, *row in zip(*(f[c] for c in (*pair, *cells)), strict=True):
                if own != (doc, dk, item, ik):
                    out += done() if rows else []
                    own, rows, size = (doc, dk, item, ik), [], (w, n, need)
                rows.append(row)
            yield pd.DataFrame(out, columns=["_doc", "_item", "share", "n_windows", "n_slots", "consistency"])
        if rows:
            yield pd.DataFrame(done(), columns=["_doc", "_item", "share", "n_windows", "n_slots", "consistency"])

    judged = streamed.mapInPandas(judge, f"_doc {doc_kind}, _item {item_kind}, share double, n_windows int, n_slots int, consistency double")
    best = F.struct("share", "consistency", "n_windows", "n_slots")
    return judged.groupBy("_doc", "_item").agg(F.max(best).alias("_b")).select(
        F.col("_doc").alias(id_col), F.col("_item").alias(item_col), "_b.share", "_b.n_windows", "_b.n_slots", "_b.consistency"
    )


def drop_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the documents that leak an item; rows with a null id stay."""
    leaks = find_leaks(docs, benchmark, id_col=id_col, text_col=text_col).select(id_col).distinct()
    return docs.join(leaks, id_col, "left_anti").select(*docs.columns)


def op5_decontamination(spark, sf_dir):
    from .common import table

    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
