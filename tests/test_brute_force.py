"""Neighbourhood answers against Python sets on random graphs with hubs."""

import random

import pytest

from kinweave import schemas
from kinweave.operators import neighbourhood
from kinweave.sources.tables import write_table


def random_graph(seed):
    """Half of all edges leave or enter one of two hubs; a third of the requests ask from a hub."""
    rng = random.Random(seed)
    names = [f"p{i}" for i in range(60)]
    def pick():
        return rng.choice(names[:2]) if rng.random() < 0.3 else rng.choice(names)
    edges = {(pick(), pick()) for _ in range(400)}
    requests = [(pick(), pick()) for _ in range(600)]
    registered = set(rng.sample(names, 50)) | {names[0]}
    return edges, requests, registered


def expected_answers(edges, requests, registered):
    out = {}
    for user, friend in edges:
        out.setdefault(user, set()).add(friend)
    levels, common, pair = {}, {}, {}
    for user, candidate in set(requests):
        middles = {m for m in out.get(user, ()) if candidate in out.get(m, ())}
        if candidate in registered and middles:
            pair[user, candidate] = middles
        if not {user, candidate} <= registered:
            continue
        if middles and user != candidate:
            common[user, candidate] = middles
        if candidate in out.get(user, ()):
            levels[user, candidate] = 1
        elif middles and user != candidate:
            levels[user, candidate] = 2
    return levels, common, pair


def as_rows(sets):
    return {(*ask, m) for ask, middles in sets.items() for m in middles}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_random_graph(make, tmp_path, seed):
    edges, requests, registered = random_graph(seed)
    edge_table = make(schemas.FRIENDSHIPS, *sorted(edges))
    id_map = make(schemas.ID_MAP, *[(user, "v" + user) for user in registered])
    people = write_table(neighbourhood.people(edge_table, id_map), str(tmp_path / "people"))
    ask = (make(schemas.REQUESTS, *requests), edge_table, people)
    levels, common, pair = expected_answers(edges, requests, registered)

    def answers(question):
        found = list(map(tuple, question(*ask).collect()))
        assert len(found) == len(set(found))
        return set(found)

    assert answers(neighbourhood.friend_levels) == {(*k, level) for k, level in levels.items()}
    assert answers(neighbourhood.one_degree) == {k for k, level in levels.items() if level == 1}
    assert answers(neighbourhood.two_degree) == {k for k, level in levels.items() if level == 2}
    assert answers(neighbourhood.common_friend_count) == {(*k, len(m)) for k, m in common.items()}
    assert answers(neighbourhood.common_friends) == as_rows(common)
    assert answers(neighbourhood.common_friends_pair) == as_rows(pair)
    assert answers(lambda *tables: neighbourhood.common_friends_set(*tables, chunks=1)) == {(*k, 0, ",".join(sorted(m))) for k, m in common.items()}


def test_rows_that_are_no_path_stay_behind(make):
    """Everybody knows 20 of 400 and asks about 20: a path in a hundred listed rows. Lists too long or too unequal for hashes are whole too."""
    rng = random.Random(3)
    edges = {(f"u{n}", f"u{rng.randrange(400)}") for n in range(400) for _ in range(20)}
    edges |= {("u0", f"u{n}") for n in range(400)} | {(f"u{n}", "u1") for n in range(400)}
    asks = {(f"u{n}", f"u{rng.randrange(400)}") for n in range(400) for _ in range(20)} | {(f"u{n}", "u1") for n in range(50)} | {("u0", "u1")}
    friendships = make(schemas.FRIENDSHIPS, *sorted(edges))
    id_map = make(schemas.ID_MAP, *[(f"u{n}", str(n)) for n in range(400)])
    requests = make(schemas.REQUESTS, *sorted(asks))
    people = neighbourhood.people(friendships, id_map)
    knows, known_by = {}, {}
    for user, friend in edges:
        knows.setdefault(user, set()).add(friend)
        known_by.setdefault(friend, set()).add(user)
    paths = {(u, c, m) for u, c in asks if u != c for m in knows[u] & known_by.get(c, set())}
    assert {tuple(row) for row in neighbourhood.common_friends(requests, friendships, people).collect()} == paths
    sized = neighbourhood._sized(requests.where("user_id <> candidate_id AND user_id <> 'u0' AND candidate_id <> 'u1'"), people)
    listed = sum(min(len(knows[u]), len(known_by.get(c, ()))) for u, c in asks if u not in (c, "u0") and c != "u1")
    shuffled = neighbourhood._steps(sized, friendships).count()
    assert shuffled < listed / 5
