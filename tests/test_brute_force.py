"""Plans against plain Python on random small inputs."""

import random
from collections import Counter

import pytest

from cohortgraph.plans import batches, levels
from cohortgraph.plans.snowball import snowball


def breadth_first(edges, seeds, inside, depth):
    level = {user: 0 for user in seeds & inside}
    frontier = set(level)
    for step in range(1, depth + 1):
        frontier = {b for a, b in edges if a in frontier and b in inside} - set(level)
        level.update({user: step for user in frontier})
    return level


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_levels(rows, seed):
    pick = random.Random(seed)
    users = [str(i) for i in range(120)]
    inside = set(pick.sample(users, 80))
    posts = [(pick.choice(users), pick.sample(users, pick.randint(0, 2))) for _ in range(150)]
    seeds = set(pick.sample(users, 4))
    members = levels.level_members(
        rows("user_id string, tweet_mentioned_user_id array<string>", *posts),
        rows("user_id string, country_short string", *[(u, "XA" if u in inside else "XB") for u in users]),
        rows("user_id string", *[(u,) for u in seeds]),
        ["XA"],
    )
    edges = {(a, b) for a, targets in posts for b in targets if a in inside}
    assert {row["user_id"]: row["level"] for row in members.collect()} == breadth_first(edges, seeds, inside, 4)


@pytest.mark.parametrize("seed", [4, 5])
def test_snowball_and_lookup_batch(rows, seed):
    pick = random.Random(seed)
    users = [str(i) for i in range(30)]
    country = {"P": "XA", "Q": "XB"}
    posts = [
        (str(i), pick.choice(users), pick.choice(["P", "Q", "R", None]), pick.choice([None, [], pick.choices(users, k=3)]),
         pick.choice([None, *users]), pick.choice([None, *users]))
        for i in range(200)
    ]
    expected = Counter()
    for _, _, place, mentioned, *others in posts:
        expected.update((target, country.get(place)) for target in [*(mentioned or []), *others] if target is not None)
    schema = (
        "tweet_id string, user_id string, user_location string, tweet_mentioned_user_id array<string>, "
        "tweet_retweeted_user_id string, tweet_in_reply_to_user_id string"
    )
    found = snowball(rows(schema, *posts), rows("user_location string, country_short string", *country.items()))
    assert {(r["user_id"], r["country_short"]): r["n_users"] for r in found.collect()} == dict(expected)
    seeds, known = set(pick.sample(users, 5)) | {"s"}, set(pick.sample(users, 12))
    batch = batches.users_batch(
        rows("user_id string", *[(u,) for u in seeds]), found, rows("user_id string", *[(u,) for u in known])
    )
    assert sorted(r["user_id"] for r in batch.collect()) == sorted((seeds | {u for u, _ in expected}) - known)
