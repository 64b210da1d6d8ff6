import json
import os

import pytest

from samples import arrive, at, stream, values
from tickloom.functions.bands import PriceBands
from tickloom.sources.tables import read_if_ready
from tickloom.streaming import medallion, observe, reseed, runtime

OPEN = PriceBands({})
COLUMNS = ["symbol", "window_start", "window_end", "avg_price", "n_ticks", "window_date"]
EARLY = [("A", float(s % 7 + 1), 1.0, at(s)) for s in range(0, 500, 3)] + [(None, 2.0, 1.0, at(444))]
# ticks for open windows, for windows that are partly closed, and for closed ones
LATER = [("A", float(s % 5 + 1), 1.0, at(s)) for s in range(500, 1500, 3)] + [("A", 9.0, 1.0, at(s)) for s in (10, 340, 370, 379, 498)]
LAST = [("B", 9.0, 1.0, at(3000)), ("A", 1.0, 1.0, at(1400))]


def gold(spark, root, inbox, batch, parts=None):
    arrive(spark, batch, inbox)
    started = medallion.start_medallion(
        stream(spark, inbox), root, OPEN, live=False, layers=[medallion.GOLD], state_partitions=parts
    )
    runtime.run_to_end(*started.values())
    return medallion.GOLD.checkpoint_path(root)


def rows(spark, *paths):
    tables = [read_if_ready(spark, path) for path in paths]
    return sorted((row for table in tables if table is not None for row in values(table.select(COLUMNS))), key=str)


def seeded(spark, folder, batch, parts=16):
    arrive(spark, batch, f"{folder}/second")
    query = reseed.start_seeded_gold(
        stream(spark, f"{folder}/second"), f"{folder}/seeds", f"{folder}/gold", f"{folder}/check", OPEN, state_partitions=parts
    )
    runtime.run_to_end(query)


@pytest.mark.parametrize("early", [EARLY, EARLY[:1], ["junk"]])
def test_more_state_partitions_give_the_gold_of_one_query(spark, folder, early):
    for batch in (early, LATER, LAST):
        gold(spark, f"{folder}/whole", f"{folder}/all", batch)
    checkpoint = gold(spark, f"{folder}/old", f"{folder}/first", early, 4)
    reseed.export_open_windows(spark, checkpoint, f"{folder}/seeds")
    for batch in (LATER, LAST):  # the second time from its own checkpoint
        seeded(spark, folder, batch)
    assert [row.numPartitions for row in observe.state_operators(spark, checkpoint).collect()] == [4]
    assert [row.numPartitions for row in observe.state_operators(spark, f"{folder}/check").collect()] == [16]
    whole = rows(spark, medallion.GOLD.path(f"{folder}/whole"))
    assert whole and rows(spark, medallion.GOLD.path(f"{folder}/old"), f"{folder}/gold") == whole


def test_where_the_old_query_stopped(spark, folder):
    checkpoint = gold(spark, folder, f"{folder}/inbox", EARLY)
    assert reseed.resume_offsets(spark, checkpoint) == [{"logOffset": 0}]
    for number, offset in ((2, 7), (10, 9), (11, 12)):  # the last one was planned and not committed
        for kind, lines in (("offsets", ["v1", "{}", json.dumps({"topic": {"0": offset}}), "-"]), ("commits", ["v1", "{}"])):
            if kind == "offsets" or number < 11:
                with open(os.path.join(checkpoint, kind, str(number)), "w") as file:
                    file.write("\n".join(lines))
    assert reseed.resume_offsets(spark, checkpoint) == [{"topic": {"0": 9}}]
