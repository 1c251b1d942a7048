"""Exact top-k search that ends early.

Items stand in order of falling norm, in bands.  A user's score for any item of
a band is at most ``|user| * |first item of the band|`` (Cauchy-Schwarz); once
that is below the user's k-th best score, no later band can change the list, and
the user is done.  Within a band, items are put together by direction into
blocks with a centre and a radius: a score is at most ``user . centre + |user| *
radius``, so blocks that point elsewhere are skipped too.  What is left is
multiplied in 32 bits, and only items that can reach the k-th best score then
are scored in 64 bits.  Rounding is covered: each bound is widened by the
largest error that products of this length can have, so ties and near ties are
still scored.
"""

from __future__ import annotations

import numpy as np

ITEM_BLOCK = 64
USER_CHUNK = 8192
# blocks of the first band, the next ones have twice as many, up to the second number
FIRST_BAND, LARGEST_BAND = 8, 256
# norms up to which 32 bits neither overflow nor lose more than ``_TINY`` to underflow
_SINGLE_MAX, _TINY = 1e15, 1e-20
_EPS, _EPS32 = np.finfo(np.float64).eps, np.finfo(np.float32).eps


def _together(vectors: np.ndarray, block: int) -> np.ndarray:
    """An order of the rows in which each ``block`` of them lies together: halved
    again and again across the direction of the largest spread."""
    parts, done = [np.arange(len(vectors))], []
    while parts:
        part = parts.pop()
        if len(part) <= block:
            done.append(part)
            continue
        half = -(-len(part) // block) // 2 * block  # whole blocks on the left
        x = vectors[part]
        with np.errstate(all="ignore"):
            x = x - x.mean(axis=0)
            spread = x.T @ x
        if np.isfinite(spread).all():
            part = part[np.argpartition(x @ np.linalg.eigh(spread)[1][:, -1], half - 1)]
        parts += [part[half:], part[:half]]
    return np.concatenate(done)


class _Band:
    """Items of similar norm, in blocks by direction."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, norms: np.ndarray, block: int, split: bool):
        self.top = norms[0]  # the largest
        order = _together(vectors, block) if split else np.arange(len(ids))
        self.ids, self.vectors, norms = ids[order], vectors[order], norms[order]
        with np.errstate(all="ignore"):
            self.single = self.vectors.astype(np.float32)
            self.starts = np.arange(0, len(ids), block)
            self.ends = np.append(self.starts[1:], len(ids))
            counts = self.ends - self.starts
            self.centres = np.add.reduceat(self.vectors, self.starts, axis=0) / counts[:, None]
            away = self.vectors - np.repeat(self.centres, counts, axis=0)
            self.radii = np.sqrt(np.maximum.reduceat((away * away).sum(axis=1), self.starts))
        self.tops = np.maximum.reduceat(norms, self.starts)


class _Lists:
    """Users of one chunk with their lists so far."""

    def __init__(self, users: np.ndarray, single: np.ndarray | None, norms: np.ndarray, best: np.ndarray, found: np.ndarray):
        self.users, self.single, self.norms, self.best, self.found = users, single, norms, best, found
        self.least = best[:, -1].copy()

    def take(self, who: np.ndarray, scores: np.ndarray, ids: np.ndarray, kk: int) -> None:
        """A row of candidates for each of the users ``who``."""
        self.best[who], self.found[who] = _merged(self.best[who], self.found[who], scores, ids, kk)
        self.least[who] = self.best[who, -1]


class ItemIndex:
    """Item ids and vectors (float64), largest norm first.  ``first_band``:
    blocks of the first band, more where lists are already filled.  ``split``:
    whether blocks are made by direction, which pays from some thousand users."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, block: int = ITEM_BLOCK, first_band: int = FIRST_BAND,
                 split: bool = True):
        norms = np.sqrt((vectors * vectors).sum(axis=1))
        order = np.lexsort((ids, -norms))
        dims = vectors.shape[1] if len(ids) else 0
        # the norms and the products are rounded too, hence these
        self._pad, self._pad32 = 8 * (dims + 2) * _EPS, 4 * (dims + 4) * _EPS32
        self._single = bool(len(ids) and norms.max() < _SINGLE_MAX)
        self._bands, self._blocks, self._n = [], -(-len(ids) // block), len(ids)
        at, size = 0, first_band
        while at < len(ids):
            part = order[at:at + size * block]
            self._bands.append(_Band(ids[part], vectors[part], norms[part], block, split))
            at, size = at + size * block, min(2 * size, LARGEST_BAND)

    def search(self, users: np.ndarray, k: int, work: dict | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the ``k`` best items of each row (fewer if there
        are fewer items): falling score, ties by lower id.  ``work`` counts
        the (user, block) pairs scored and skipped."""
        kk, n = min(k, self._n), len(users)
        ids = np.empty((n, kk), dtype=np.int64)
        scores = np.empty((n, kk))
        for a in range(0, n if kk else 0, USER_CHUNK):
            part = users[a:a + USER_CHUNK]
            best, found = nothing_found(len(part), kk)
            ids[a:a + USER_CHUNK], scores[a:a + USER_CHUNK] = self._chunk(part, kk, best, found, work)
        return ids, scores

    def _chunk(self, users: np.ndarray, kk: int, best: np.ndarray, found: np.ndarray,
               work: dict | None = None) -> tuple[np.ndarray, np.ndarray]:
        norms = np.sqrt((users * users).sum(axis=1))
        single = users.astype(np.float32) if self._single and len(norms) and norms.max() < _SINGLE_MAX else None
        lists = _Lists(users, single, norms, best, found)
        going, scored = np.arange(len(users)), 0
        for band in self._bands:
            # "not below" also keeps users whose bound isn't a number
            going = going[~(norms[going] * (band.top * (1 + self._pad)) < lists.least[going])]
            if not len(going):
                break
            length = norms[going]
            with np.errstate(all="ignore"):
                # block by user, so that what a block needs lies together
                bound = band.centres @ users[going].T
                bound += (band.radii * (1 + self._pad) + band.top * self._pad)[:, None] * length
                np.minimum(bound, (band.tops * (1 + self._pad))[:, None] * length, out=bound)
            todo = np.ones(bound.shape, dtype=bool)
            # users without a full list yet: the most promising block first
            empty = np.flatnonzero(np.isneginf(lists.least[going]))
            first = bound[:, empty].argmax(axis=0)
            for b in np.unique(first):
                rows = empty[first == b]
                scored += len(rows)
                self._score(band, b, lists, going[rows], kk)
                todo[b, rows] = False
            todo &= ~(bound < lists.least[going])
            for b in np.flatnonzero(todo.any(axis=1)):
                rows = np.flatnonzero(todo[b])
                at = going[rows]
                at = at[~(bound[b, rows] < lists.least[at])]
                scored += len(at)
                if len(at):
                    self._score(band, b, lists, at, kk)
        if work is not None:
            work["scored"] = work.get("scored", 0) + scored
            work["skipped"] = work.get("skipped", 0) + len(users) * self._blocks - scored
        return found, best

    def _score(self, band: _Band, b: int, lists: _Lists, at: np.ndarray, kk: int) -> None:
        """The items of one block into the lists of the users ``at``."""
        a, z = band.starts[b], band.ends[b]
        least = lists.least[at]
        if lists.single is None:
            rough, items, pad = lists.users, band.vectors, self._pad
        else:
            rough, items, pad = lists.single, band.single, self._pad32
        # item by user: the largest of a column is found fastest so
        s = items[a:z] @ np.take(rough, at, axis=0).T
        floor = (least - (lists.norms[at] * (band.tops[b] * pad) + np.abs(least) * pad + _TINY)).astype(s.dtype)
        hit = np.flatnonzero(~(s.max(axis=0) < floor))
        if not len(hit):
            return
        row, item = np.nonzero(~(s[:, hit] < floor[hit]).T)
        row = hit[row]
        s = np.einsum("ij,ij->i", lists.users[at[row]], band.vectors[a + item])
        kept = ~(s < least[row])
        row, item, s = row[kept], item[kept], s[kept]
        if not len(row):
            return
        # a row per user with candidates, as wide as the most candidates of one
        starts = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
        counts = np.diff(np.append(starts, len(row)))
        line, column = np.repeat(np.arange(len(starts)), counts), np.arange(len(row)) - np.repeat(starts, counts)
        scores, ids = nothing_found(len(starts), counts.max())
        scores[line, column], ids[line, column] = s, band.ids[a + item]
        lists.take(at[row[starts]], scores, ids, kk)


def nothing_found(n: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Scores and ids of ``n`` lists without an item yet."""
    return np.full((n, k), -np.inf), np.full((n, k), np.iinfo(np.int64).max)


class RunningSearch:
    """The same search where the items come in several indexes, one after the
    other by falling norm: the lists so far of a group of users."""

    def __init__(self, users: np.ndarray, k: int):
        self._users, self._k = users, k
        self.scores, self.ids = nothing_found(len(users), k)
        self._norms = np.sqrt((users * users).sum(axis=1))
        self._going = np.arange(len(users))
        self._slack = 1 + 8 * (users.shape[1] + 2) * _EPS

    def going(self, top: float) -> int:
        """How many lists an item with a norm of at most ``top`` can still change."""
        bound = self._norms[self._going] * (top * self._slack)
        self._going = self._going[~(bound < self.scores[self._going, -1])]
        return len(self._going)

    def add(self, index: ItemIndex) -> None:
        for a in range(0, len(self._going), USER_CHUNK):
            at = self._going[a:a + USER_CHUNK]
            self.ids[at], self.scores[at] = index._chunk(self._users[at], self._k, self.scores[at], self.ids[at])


def _merged(best: np.ndarray, found: np.ndarray, s: np.ndarray, ids: np.ndarray, kk: int) -> tuple[np.ndarray, np.ndarray]:
    """The kk best of the lists so far and one block's candidates, in order."""
    scores, every = np.hstack([best, s]), np.hstack([found, ids])
    keep = np.argpartition(-scores, kk - 1, axis=1)[:, :kk]
    least = np.take_along_axis(scores, keep, axis=1).min(axis=1)
    tied = (scores >= least[:, None]).sum(axis=1) > kk
    if tied.any():  # ties across the border: the whole order for these rows
        keep[tied] = np.lexsort((every[tied], -scores[tied]), axis=1)[:, :kk]
    scores, every = np.take_along_axis(scores, keep, axis=1), np.take_along_axis(every, keep, axis=1)
    order = np.lexsort((every, -scores), axis=1)
    return np.take_along_axis(scores, order, axis=1), np.take_along_axis(every, order, axis=1)
