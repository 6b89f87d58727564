"""Resolution law: the flattened lookup, the three-branch shape and a plain model agree.

Random trees mix every node type (and unknown / NULL types), dangling and
wrong-level parents; random users point their district / region ids anywhere
in the tree, at missing ids, empty strings or NULL, with copies and NULL keys.
"""

from __future__ import annotations

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from regiontally.operators import hierarchy
from regiontally.operators.hierarchy import MAPPED_COLUMNS
from tests import fixtures as fx

NODE_IDS = [f"N{i}" for i in range(8)]
TYPES = ["COUNTRY", "REGION", "CITY", "DISTRICT", "OTHER", None]
POINTERS = NODE_IDS + ["MISSING", "", None]

trees = st.lists(
    st.tuples(st.sampled_from(TYPES), st.sampled_from(POINTERS), st.sampled_from(["a", "b", None])),
    min_size=len(NODE_IDS),
    max_size=len(NODE_IDS),
).map(lambda rows: [(NODE_IDS[i], name, t, parent) for i, (t, parent, name) in enumerate(rows)])

users = st.lists(
    st.tuples(
        st.sampled_from(["u1", "u2", "u3", None]),
        st.sampled_from(POINTERS),
        st.sampled_from(POINTERS),
        st.sampled_from([True, False, None]),
    ),
    max_size=12,
)


def model(tree, user_rows):
    """The resolution rules written directly."""
    node = {i: (n, t, p) for i, n, t, p in tree}

    def level(i, t):
        return i in node and node[i][1] == t

    def region_of_city(c):
        parent = node[c][2]
        return parent if level(parent, "REGION") else None

    out = set()
    for uid, district, region, active in user_rows:
        target = None
        if district is not None:
            if level(district, "DISTRICT") and level(node[district][2], "CITY"):
                target = region_of_city(node[district][2])
        elif region is not None:
            if level(region, "CITY"):
                target = region_of_city(region)
            elif level(region, "REGION"):
                target = region
        if target is not None:
            out.add((uid, active, target, node[target][0]))
    return out


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(tree=trees, user_rows=users)
def test_lookup_branches_and_model_agree(spark, tree, user_rows):
    from regiontally.schemas import REGION_SCHEMA
    from regiontally.sources.readers import prepare_regions

    docs = [(i, None, n, t, p, None, None, None, None, None) for i, n, t, p in tree]
    regions = prepare_regions(spark.createDataFrame(docs, REGION_SCHEMA))
    people = fx.users(spark, [(u, d, r, None, a) for u, d, r, a in user_rows])
    expected = model(tree, user_rows)
    via_lookup = {tuple(r[c] for c in MAPPED_COLUMNS) for r in hierarchy.users_mapped(people, regions).collect()}
    via_branches = {
        tuple(r[c] for c in MAPPED_COLUMNS) for r in hierarchy.users_mapped_by_level(people, regions).collect()
    }
    assert via_lookup == expected
    assert via_branches == expected
