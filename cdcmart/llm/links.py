"""Groups among the pairs of one task."""

from __future__ import annotations

import numpy as np


def local_groups(one: np.ndarray, other: np.ndarray) -> list[tuple[int, int]]:
    """(member, root) for every member of the pairs: members that pairs join have one root, a member itself."""
    members, at = np.unique(np.concatenate([one, other]), return_inverse=True)
    a, b = at[: len(one)], at[len(one) :]
    label = np.arange(len(members))
    while True:
        # Both ends take the smaller label, and labels follow their own label.
        least = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, least)
        np.minimum.at(new, b, least)
        np.minimum.at(new, label[a], least)
        np.minimum.at(new, label[b], least)
        new = new[new]
        if (new == label).all():
            return list(zip(members.tolist(), members[label].tolist()))
        label = new
