import pytest

from kinweave import schemas
from kinweave.operators import neighbourhood
from kinweave.plans.questions import FriendGraph, requests_of
from kinweave.sources.tables import write_table
from test_brute_force import expected_answers, random_graph


@pytest.fixture(scope="module")
def asked(make, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("questions"))
    edges, requests, registered = random_graph(4)
    by_user = write_table(make(schemas.FRIENDSHIPS, *sorted(edges)), f"{folder}/by_user")
    by_friend = write_table(make(schemas.FRIENDSHIPS, *sorted(edges, key=lambda e: e[::-1])), f"{folder}/by_friend")
    id_map = make(schemas.ID_MAP, *[(user, "v" + user) for user in sorted(registered)])
    people = write_table(neighbourhood.people(by_user, id_map), f"{folder}/people")
    candidates = [candidate for user, candidate in requests if user == "p0"]
    answers = expected_answers(edges, [("p0", candidate) for candidate in candidates], registered)
    return FriendGraph(by_user, by_friend, people), candidates, answers


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_one_user_asks_about_a_list(asked):
    graph, candidates, (levels, common, _) = asked
    assert rows(graph.friend_levels("p0", candidates)) == sorted((*k, level) for k, level in levels.items())
    assert rows(graph.common_friend_count("p0", candidates)) == sorted((*k, len(m)) for k, m in common.items())
    assert rows(graph.common_friends("p0", candidates)) == sorted((*k, m) for k, ms in common.items() for m in ms)


def test_one_user_asks_about_another(asked):
    graph, _, (_, _, pair) = asked
    (user, other), middles = sorted(pair.items())[0]
    assert rows(graph.common_friends_pair(user, other)) == sorted((user, other, m) for m in middles)


def test_empty_list_and_unknown_user(asked):
    graph, candidates, _ = asked
    assert rows(graph.friend_levels("p0", [])) == []
    assert rows(graph.common_friends("nobody", candidates)) == []


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_own_edges_are_a_filter_that_reaches_the_scan(asked):
    graph, candidates, _ = asked
    edges, _ = graph.narrowed("p0", requests_of(graph.by_user.sparkSession, "p0", candidates))
    plan = plan_of(edges)
    assert "EqualTo(user_id,p0)" in plan.split("PushedFilters")[1]
    assert plan.count("LeftSemi, BuildRight") == 1 and plan.count("FileScan") == 2 and "SortMergeJoin" not in plan


def test_edges_into_a_long_list_meet_it_before_any_other_shuffle(asked):
    graph, candidates, _ = asked
    session = graph.by_user.sparkSession
    session.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        edges, _ = graph.narrowed("p0", requests_of(session, "p0", candidates))
        plan = plan_of(edges)
    finally:
        session.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("SortMergeJoin [friend_user_id") == 1 and plan.count("Exchange hashpartitioning(friend_user_id") == 2
    assert plan.count("Exchange") == 2 and "EqualTo(user_id,p0)" in plan


def state(graph):
    edges = rows(graph.by_user)
    assert edges == rows(graph.by_friend)
    return edges, {row.user_id: (row.registered, row.out_degree, row.in_degree) for row in graph.people.collect()}


def test_single_changes_keep_edges_and_people_in_step(asked):
    graph, _, _ = asked
    before, people = state(graph)
    changed = graph.with_changes(adds=[("new", "p0"), before[0], ("p0", "other"), ("p0", "other")], deletes=[before[1], ("no", "body")])
    after, people_after = state(changed)
    assert after == sorted((set(before) - {before[1]}) | {("new", "p0"), ("p0", "other")})
    expected = {user: [registered, 0, 0] for user, (registered, _, _) in people.items()}
    for user in ("new", "p0", "other", *before[0]):
        expected.setdefault(user, [True, 0, 0])[0] = True
    for user, friend in after:
        expected[user][1] += 1
        expected[friend][2] += 1
    assert people_after == {user: tuple(row) for user, row in expected.items()}


def test_a_new_user_is_answered_at_once(asked):
    graph, _, _ = asked
    assert rows(graph.with_changes(adds=[("new", "p0")]).friend_levels("new", ["p0"])) == [("new", "p0", 1)]


def test_a_short_list_of_changes_shuffles_no_edges(asked):
    graph, _, _ = asked
    for table in ("by_user", "by_friend"):
        plan = plan_of(getattr(graph.with_changes(adds=[("new", "p0")], deletes=[("p0", "p1")]), table))
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
