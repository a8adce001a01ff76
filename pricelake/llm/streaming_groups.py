"""Groups of sorted rows that arrive batch by batch, in bounded memory."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


class SharedGroups:
    """Finds the groups with two different members or more.

    Rows come sorted by group, then member.  ``feed`` returns, for a batch,
    which rows are the first of their member in the group (``fresh``), which
    of these lie in a group known to be shared (``keep``), the first member of
    each row's group, and the one earlier row that turned out to be shared
    now.  Only that one row is held between batches.
    """

    def __init__(self):
        self.last = self.pending = self.leader = None
        self.shared = False

    def feed(self, batch: pa.RecordBatch, group: list[np.ndarray],
             member: np.ndarray):
        new = np.zeros(len(member), bool)
        for g in group:
            new[1:] |= g[1:] != g[:-1]
        goes_on = self.last is not None and all(
            g[0] == x for g, x in zip(group, self.last[0]))
        new[0] = not goes_on
        fresh = new.copy()
        fresh[1:] |= member[1:] != member[:-1]
        fresh[0] = new[0] or member[0] != self.last[1]
        number = np.cumsum(new)              # 0: goes on from the last batch
        count = np.bincount(number[fresh], minlength=number[-1] + 1)
        if goes_on:
            count[0] += 2 if self.shared else 1
        shared = count > 1
        keep = fresh & shared[number]
        late = self.pending if goes_on and not self.shared and shared[0] \
            else None
        lead = member[np.append(0, np.flatnonzero(new))[number]]
        if goes_on:
            lead = np.where(number == 0, self.leader, lead)
        self.shared = bool(shared[-1])
        if self.shared:
            self.pending = None
        else:
            own = np.flatnonzero(fresh & (number == number[-1]))
            if len(own):
                self.pending = batch.slice(int(own[0]), 1)
        self.last = (tuple(g[-1] for g in group), member[-1])
        self.leader = lead[-1]
        return fresh, keep, lead, late
