"""Links of near copies: what one band has joined up is not linked again by the others."""

import pyarrow as pa

from tilewright.llm import simhash


def test_links_that_are_known_are_left_out():
    kind = pa.list_(pa.struct([("value", pa.int64()), ("node", pa.int64()), ("bands", pa.list_(pa.int64())), ("root", pa.int64())]))
    lists = [[{"value": 0, "node": n, "bands": [0, 0], "root": n} for n in range(12)]] * 320
    run = simhash._search_lists(4, 100)

    def links(lists):
        return [x for b in run(iter([pa.RecordBatch.from_arrays([pa.array(lists, kind)], ["rows"])])) for x in zip(*(c.to_pylist() for c in b.columns))]

    assert len(links(lists)) == 11  # 320 lists of one group, a spanning tree
    assert links([[r | {"root": 0} for r in own] for own in lists]) == []
    apart = [[r | {"root": r["node"] // 6 * 6} for r in lists[0]]]
    assert len(links(apart)) == 1
