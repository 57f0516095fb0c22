"""Proteins against nucleotides: local alignment over codons with affine gaps and shifts of the frame, many pairs at a time."""

from __future__ import annotations

import dataclasses

import numpy as np

from .seq import _AMINO, _BASES

#: Dayhoff's classes of amino acids.
CLASSES = ("AGPST", "C", "DENQ", "FWY", "HKR", "ILMV")
_NOTHING = 27
_LOW = -(1 << 58)
#: A value packs the score and where the alignment starts (residue, base).
_I, _J = 40, 21
#: What is carried beside it: columns that score above zero, columns, shifts of the frame.
_POSITIVE, _COLUMN = 40, 20
#: Cells of a row over all pairs of a batch.
CELLS = 1 << 17


@dataclasses.dataclass(frozen=True)
class Costs:
    """Scores of residues of one kind, of one class and of others; of an unknown one, of a stop against anything else;
    costs of a gap of n codons (``gap_open + n * gap_extend``) and of a shift. ``table`` takes their place: scores by pairs of letters."""

    same: int = 5
    like: int = 1
    unlike: int = -2
    unknown: int = -1
    stop: int = -6
    gap_open: int = 8
    gap_extend: int = 2
    shift: int = 14
    table: tuple[tuple[str, str, int], ...] = ()

    def scores(self) -> np.ndarray:
        """A row and a column for each letter, the stop and, last, nothing."""
        out = np.full((28, 28), self.unlike, dtype=np.int64)
        for group in CLASSES:
            at = [ord(c) - 65 for c in group]
            out[np.ix_(at, at)] = self.like
        np.fill_diagonal(out, self.same)
        out[26, :] = out[:, 26] = self.stop
        out[26, 26] = self.same
        for a, b, s in self.table:
            out[_code(a), _code(b)] = out[_code(b), _code(a)] = s
        out[23, :] = out[:, 23] = self.unknown
        out[27, :] = out[:, 27] = _LOW >> _I
        return out


def _code(letter: str) -> int:
    return 26 if letter == "*" else ord(letter) - 65


_OF_BYTE = np.full(256, 23, dtype=np.int64)
_OF_BYTE[[*range(65, 91), *range(97, 123), 42]] = [*range(26), *range(26), 26]
_BASE = np.full(256, 4, dtype=np.int64)
for _k, _b in enumerate(_BASES):
    _BASE[[ord(_b), ord(_b.lower())]] = _k
_AMINO_OF = np.array([_code(a) for a in _AMINO])


def residues(protein: str) -> np.ndarray:
    return _OF_BYTE[np.frombuffer(protein.encode("latin-1", "replace"), dtype=np.uint8)]


def codon_residues(dna: str) -> np.ndarray:
    """The residue of the codon that ends after each number of bases; nothing before the third."""
    base = _BASE[np.frombuffer(dna.encode("latin-1", "replace"), dtype=np.uint8)]
    out = np.full(len(base) + 1, _NOTHING)
    if len(base) >= 3:
        a, b, c = base[:-2], base[1:-1], base[2:]
        known = (a < 4) & (b < 4) & (c < 4)
        out[3:] = np.where(known, _AMINO_OF[np.where(known, 16 * a + 4 * b + c, 0)], 23)
    return out


def _moved(a: np.ndarray, by: int, fill: int) -> np.ndarray:
    out = np.full_like(a, fill)
    out[:, by:] = a[:, :-by]
    return out


def _better(a, b):
    on = b[0] > a[0]
    return np.where(on, b[0], a[0]), np.where(on, b[1], a[1])


def best_local(proteins: list[str], sequences: list[str], costs: Costs = Costs()) -> np.ndarray:
    """For each pair: score, start and end in the protein, start and end in the bases, columns that score above zero, columns, shifts.

    A column is a residue against a codon, or either against a gap. A shift skips a base or two, or sets a residue against
    only one or two; one that skips is not taken right after codons that are against a gap. A row of all pairs is a few
    operations on arrays. No alignment is all zeros."""
    many, rows = len(proteins), max(map(len, proteins), default=0)
    width = -(-(max(map(len, sequences), default=0) + 1) // 3) * 3
    p, aa = np.full((many, rows), _NOTHING), np.full((many, width), _NOTHING)
    for k in range(many):
        p[k, : len(proteins[k])], aa[k, : len(sequences[k]) + 1] = residues(proteins[k]), codon_residues(sequences[k])
    table, places = costs.scores(), np.arange(width, dtype=np.int64)
    opened, gap, shift = -costs.gap_open << _I, -costs.gap_extend << _I, -costs.shift << _I
    column, codons = 1 << _COLUMN, np.arange(width // 3, dtype=np.int64)[None, :, None]
    h = np.broadcast_to(places, (many, width)).copy(), np.zeros((many, width), dtype=np.int64)
    f = np.full_like(h[0], _LOW), h[1]
    best, found = np.zeros(many, dtype=np.int64), np.zeros((many, 8), dtype=np.int64)
    for i in range(1, rows + 1):
        sub = table[p[:, i - 1, None], aa]
        cell = _moved(h[0], 3, _LOW) + (sub << _I), _moved(h[1], 3, 0) + column + ((sub > 0).astype(np.int64) << _POSITIVE)
        for bases in (2, 1):
            cell = _better(cell, (_moved(h[0], bases, _LOW) + shift, _moved(h[1], bases, 0) + column + 1))
        a, b = h[0] + opened, f[0]
        f = np.maximum(a, b) + gap, np.where(b > a, f[1], h[1]) + column
        cell = _better(cell, f)
        cell = _better((np.broadcast_to((i << _J) + places, cell[0].shape), np.zeros_like(cell[1])), cell)
        cell = _better(_better(cell, (_moved(cell[0], 1, _LOW) + shift, _moved(cell[1], 1, 0) + 1)), (_moved(cell[0], 2, _LOW) + shift, _moved(cell[1], 2, 0) + 1))
        # codons against a gap: the best place before, of those as many bases away by threes
        v = cell[0].reshape(many, -1, 3) - codons * gap
        top = np.maximum.accumulate(v, axis=1)
        at = np.maximum.accumulate(np.where(v == top, codons, 0), axis=1)
        e, beside = np.full_like(v, _LOW), np.zeros_like(v)
        e[:, 1:] = top[:, :-1] + codons[:, 1:] * gap + opened
        beside[:, 1:] = np.take_along_axis(cell[1].reshape(many, -1, 3), at[:, :-1], axis=1) + (codons[:, 1:] - at[:, :-1]) * column
        h = _better(cell, (e.reshape(many, width), beside.reshape(many, width)))
        j = h[0].argmax(axis=1)
        value, more = h[0][np.arange(many), j], h[1][np.arange(many), j]
        won = np.flatnonzero((value >> _I) > (best >> _I))
        best[won] = value[won]
        low = value[won] & ((1 << _I) - 1)
        found[won] = np.stack([value[won] >> _I, low >> _J, np.full(len(won), i), low & ((1 << _J) - 1), j[won], more[won] >> _POSITIVE, (more[won] >> _COLUMN) & ((1 << 20) - 1), more[won] & ((1 << 20) - 1)], axis=1)
    return found


def best_local_batched(proteins: list[str], sequences: list[str], costs: Costs = Costs()) -> np.ndarray:
    """:func:`best_local`, pairs of like lengths at a time within a bound of cells."""
    out = np.zeros((len(proteins), 8), dtype=np.int64)
    order = sorted(range(len(proteins)), key=lambda k: (len(sequences[k]), len(proteins[k])))
    while order:
        size = max(1, CELLS // (len(sequences[order[-1]]) + 4))
        some, order = order[-size:], order[:-size]
        out[some] = best_local([proteins[k] for k in some], [sequences[k] for k in some], costs)
    return out
