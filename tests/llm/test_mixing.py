import pytest

from graphfeed.llm import mixing as M


def brute_targets(sizes):
    """Cap and reshare until no target is above its cap."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: M.WEIGHTS[i % 3] for i, s in enumerate(names)}
    target, left, open_ = {}, M.SHARE * sum(sizes.values()), set(names)
    while open_:
        whole = sum(weight[s] for s in open_)
        full = {s for s in open_ if left * weight[s] / whole > M.MOST * sizes[s]}
        if not full:
            return target | {s: left * weight[s] / whole for s in open_}
        for s in full:
            target[s] = M.MOST * sizes[s]
        left -= sum(target[s] for s in full)
        open_ -= full
    return target


@pytest.fixture(scope="module")
def docs(frame):
    rows = [(i, "w " * (1 + i * 7 % 90), f"s{i % 7}" if i % 11 else None) for i in range(700)]
    rows += [(10_000 + i, "same words here", "hot") for i in range(600)]
    rows += [(None, None, "s1"), (None, "x", "s1"), (5, "rep rep", "s2"), (5, "rep rep", "s2"), (9, "", "zero")]
    return frame(rows)


def test_targets_and_taken(docs):
    rows = M.taken(docs).collect()
    sizes = {}
    for d in docs.collect():
        sizes[d.source] = sizes.get(d.source, 0) + len((d.text or "").split())
    want = brute_targets(sizes)
    by_size = {}
    for r in rows:
        assert r.taken <= 2 * r.size and (r.size == 0 or r.taken % r.size == 0)
        by_size.setdefault(r.source_size, []).append(r)
    assert len(rows) == docs.count() and sorted(by_size) == sorted(set(sizes.values()))
    assert sum({r.source_size: r.target for r in rows}.values()) == pytest.approx(1.5 * sum(sizes.values()))
    for source, size in sizes.items():
        group = by_size[size]
        assert group[0].target == pytest.approx(want[source])
        assert abs(sum(r.taken for r in group) - want[source]) <= 2 * max(r.size for r in group)
    assert sorted(map(str, rows)) == sorted(map(str, M.taken(docs.repartition(7)).collect()))


def test_mixed_rows_follow_taken(docs):
    out = M.mixed(docs)
    assert out.columns == docs.columns
    words = sum(len((r.text or "").split()) for r in out.collect())
    assert words == sum(r.taken for r in M.taken(docs).collect())


def test_empty(docs):
    assert M.taken(docs.limit(0)).count() == 0 and M.mixed(docs.limit(0)).count() == 0
