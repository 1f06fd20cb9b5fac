"""Licence scan: normalised text against licence templates by the Dice coefficient over word bigrams.

Text is normalised to its words (see textcore). A match is a span of a text that begins and ends with a bigram of a template and
reaches Dice ``dice`` with it. A span of b distinct bigrams can only do so if b lies between t * d / (2 - d) and t * (2 - d) / d
for a template of t, and if at least t * d / (2 - d) of its bigrams are the template's. So a template is only compared where
that many of its bigrams stand within the greatest size; all others are pruned without loss. Spans do not mind lines, so a
notice is found inside longer lines, wrapped, or next to other text. From each such start the end of the greatest Dice is
taken (the nearest on ties). A span must hold the template's numbers and distinctive names, and no other distinctive name:
versions and variants of a licence differ by little else.

Of overlapping matches the greatest Dice stays, then the most shared bigrams, then the first template, then the first place.

Defined results: a null text, and one that matches nothing, gets a null licence, Dice 0 and no matches; repeated rows are
judged alike; an empty table gives an empty table; extra columns are not read. Work grows with the text and its matches; a
text longer than a slice is read alone, in memory that grows with it.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from cinelake.llm.license_texts import NAMES, TEMPLATES
from cinelake.llm.textcore import column_bytes, slices, windows, words

DICE = 0.8


@dataclass(frozen=True)
class Prepared:
    """sets: each template's bigrams; vocabulary: all of them; of each one its templates in owner[first[i] : first[i + 1]];
    longest: positions that a span may take; must: numbers and names of each template; names: hashes of the names."""

    sets: list[np.ndarray]
    vocabulary: np.ndarray
    first: np.ndarray
    owner: np.ndarray
    size: np.ndarray
    longest: np.ndarray
    must: list[frozenset[int]]
    names: frozenset[int]


@lru_cache(maxsize=4)
def _prepared(templates: tuple[tuple[str, str], ...], dice: float) -> Prepared:
    hashes, _, upto = words(*column_bytes(pa.array([t for _, t in templates], pa.string())))
    special = set(words(*column_bytes(pa.array(NAMES)))[0].tolist())
    numbers = set(words(*column_bytes(pa.array([str(i) for i in range(100)])))[0].tolist())
    each = [hashes[a:b] for a, b in zip(upto[:-1], upto[1:])]
    sets = [np.unique(windows(x, 2)) for x in each]
    vocabulary, at = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    order = np.argsort(at, kind="stable")
    longest = np.array([int((len(x) - 1) * (2 - dice) / dice + 1e-9) for x in each])
    must = [frozenset(set(x.tolist()) & (special | numbers)) for x in each]
    first = np.searchsorted(at[order], np.arange(len(vocabulary) + 1))
    return Prepared(sets, vocabulary, first, owner[order], np.array([len(x) for x in sets]), longest, must, frozenset(special))


def _best_end(own: np.ndarray, template: np.ndarray) -> tuple[float, int, int]:
    """Of the spans that start here and end with a template's bigram: the greatest Dice, its length, its shared bigrams."""
    _, at = np.unique(own, return_index=True)
    new = np.zeros(len(own), dtype=np.int64)
    new[at] = 1
    known = template[np.minimum(np.searchsorted(template, own), len(template) - 1)] == own
    shared = np.cumsum(new * known)
    dice = np.where(known, 2 * shared / (np.cumsum(new) + len(template)), 0.0)
    end = int(dice.argmax())
    return float(dice[end]), end + 1, int(shared[end])


def scan_slice(
    data: np.ndarray, offsets: np.ndarray, templates: tuple[tuple[str, str], ...], dice: float
) -> list[tuple[int, int, int, int, float]]:
    """(text, first word, end word, template, Dice) of every match, by text and place."""
    p = _prepared(templates, dice)
    hashes, text, upto = words(data, offsets)
    if len(hashes) < 2:
        return []
    bigram = windows(hashes, 2)
    code = np.minimum(np.searchsorted(p.vocabulary, bigram), len(p.vocabulary) - 1)
    at = np.flatnonzero((p.vocabulary[code] == bigram) & (text[:-1] == text[1:]))
    many = np.diff(p.first)[code[at]]
    within = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    template = p.owner[np.repeat(p.first[code[at]], many) + within]
    place = np.repeat(at, many)
    order = np.lexsort((place, template))  # texts follow one another, so places tell them apart
    template, place = template[order], place[order]
    need = np.maximum(np.ceil(p.size * dice / (2 - dice) - 1e-9).astype(np.int64), 1)[template]
    other = np.arange(len(place)) + need - 1
    ok = other < len(place)
    ok[ok] &= (template[other[ok]] == template[ok]) & (place[other[ok]] - place[ok] < p.longest[template[ok]])
    ok[ok] &= text[place[other[ok]]] == text[place[ok]]
    found: list[tuple[int, float, int, int, int, int]] = []
    for i in np.flatnonzero(ok):
        t, a = int(template[i]), int(place[i])
        end = min(a + int(p.longest[t]), int(upto[text[a] + 1]) - 1)
        d, length, shared = _best_end(bigram[a:end], p.sets[t])
        if d >= dice:
            own = set(hashes[a : a + length + 1].tolist())
            if p.must[t] <= own and own & p.names <= p.must[t]:
                found.append((int(text[a]), -d, -shared, t, a, a + length + 1))
    out: list[tuple[int, int, int, int, float]] = []
    taken: dict[int, list[tuple[int, int]]] = {}
    for own, d, _, t, a, b in sorted(found):
        spans = taken.setdefault(own, [])
        k = bisect_right(spans, (a, b))
        if (k == 0 or spans[k - 1][1] <= a) and (k == len(spans) or b <= spans[k][0]):
            spans.insert(k, (a, b))
            out.append((own, a - int(upto[own]), b - int(upto[own]), t, -d))
    return sorted(out)


SCHEMA = "license string, dice double, n_matches bigint, licenses string, spans string"


def scan_licenses(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    templates: Sequence[tuple[str, str]] = TEMPLATES,
    dice: float = DICE,
) -> DataFrame:
    """One row per row: id, the licence of the best match, its Dice, the number of matches, all licences found, and the matches
    as ``licence:first word:end word``."""
    src = docs.select(id_col, text_col)
    out = T.StructType([src.schema[id_col], *T._parse_datatype_string(SCHEMA).fields])
    templates = tuple(templates)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows: list[tuple] = [(None, 0.0, 0, "", "")] * b.num_rows
            for first, _, data, offsets in slices(b.column(1)):
                found: dict[int, list[tuple[int, int, int, float]]] = {}
                for text, a, e, t, d in scan_slice(data, offsets, templates, dice):
                    found.setdefault(text, []).append((a, e, t, d))
                for text, hits in found.items():
                    _, _, t, d = min(hits, key=lambda x: (-x[3], x[2], x[0]))
                    names = sorted({templates[x[2]][0] for x in hits})
                    spans = ",".join(f"{templates[t][0]}:{a}:{e}" for a, e, t, _ in hits)
                    rows[first + text] = (templates[t][0], d, len(hits), ",".join(names), spans)
            kinds = [pa.string(), pa.float64(), pa.int64(), pa.string(), pa.string()]
            cols = list(zip(*rows)) if rows else [()] * 5
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.array(c, k) for c, k in zip(cols, kinds))], names=[f.name for f in out]
            )

    return src.mapInArrow(run, out)
