import numpy as np
import pyarrow as pa
import pytest

from ratingloom.operators import scoring


def _brute(user, ids, items, take):
    scores = (items.astype(np.float64) * user.astype(np.float64)).sum(axis=1)
    return [(int(ids[i]), float(scores[i])) for i in np.lexsort((-ids.astype(np.int64), -scores))[:take]]


def _lists(batches):
    found = {}
    for user, movie, score in zip(*pa.Table.from_batches(batches, scoring._ARROW).to_pydict().values(), strict=True):
        found.setdefault(user, []).append((movie, score))
    return found


@pytest.mark.parametrize("scale", [1.0, 1e-9, 1e25])
@pytest.mark.parametrize("different", [7, 400])
def test_blocks_in_either_precision_give_the_lists_of_brute_force(scale, different, monkeypatch):
    rng = np.random.default_rng(3)
    monkeypatch.setattr(scoring, "_MET_BYTES", 50 * 8 * 6)  # blocks of 50 items
    monkeypatch.setattr(scoring, "_NEAR_BUDGET", 20)
    users = rng.normal(size=(30, 6)) * scale
    users[3] = 0
    items = rng.normal(size=(400, 6))[rng.integers(0, different, 400)] * scale
    ids, user_ids, takes = rng.permutation(400).astype(np.int32), np.arange(30)[::-1] * 2, rng.integers(1, 12, 30)
    found = _lists(scoring._best_of_all(user_ids, users, takes, ids, items))
    for user_id, user, take in zip(user_ids, users, takes, strict=True):
        assert sorted(found[user_id], key=lambda e: (-e[1], -e[0])) == _brute(user, ids, items, take)


def test_precision_is_double_where_lengths_leave_the_range_of_single():
    assert scoring._precision(np.array([1.0, 0.0]), 2.0) is np.float32
    for lengths, longest in (([1e20], 1.0), ([1.0], 1e20), ([1e-20], 1.0), ([1.0], 0.0), ([np.nan], 1.0), ([1.0], np.nan)):
        assert scoring._precision(np.array(lengths), longest) is np.float64


def test_items_below_the_score_reached_so_far_are_not_scored_again():
    users, items = np.eye(2), np.array([[5.0, 1.0], [4.0, 2.0], [3.0, 9.0]])
    user_ids, takes, ids = np.array([8, 4]), np.array([2, 2]), np.arange(3)
    best = pa.Table.from_batches(scoring._best(user_ids, users, takes, ids, items), scoring._ARROW)
    floors = scoring._floors(best, user_ids, takes)
    assert floors.tolist() == [4.0, 2.0]
    assert scoring._floors(best, user_ids, np.array([2, 3])).tolist() == [4.0, -np.inf]
    later = np.array([[3.9, 2.0], [4.1, 1.0], [0.0, 0.0]])
    assert _lists(scoring._best(user_ids, users, takes, ids + 3, later, floors)) == {8: [(4, 4.1)], 4: [(3, 2.0)]}
