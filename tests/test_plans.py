"""Plan-shape checks on the operators themselves (not on tables that were
already written): no Python, no cartesian or nested-loop joins, passes over the
ping table read its layout, projections reach the scan."""

import re

import pytest

import __spark_entry__ as E
from fleetspark.operators.asof import close_pairs, confirmed_loads, nearest_loaders
from fleetspark.operators.dumps import body_up_events, geofence_events
from fleetspark.operators.pings import ping_pass
from fleetspark.operators.sequence import sequence_rows
from fleetspark.operators.shift import ping_measures, shift_aggregate, shift_features
from fleetspark.operators.stops import dump_candidates, load_candidates, stop_events
from fleetspark.operators.trips import cycle_times, marked_pings, trip_aggregate, trip_state
from fleetspark.plans import queries as Q

from .conftest import SF_SMALL


@pytest.fixture(scope="module")
def ctx(spark):
    return Q._ctx(spark, SF_SMALL)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def state(c):
    return trip_state(marked_pings(ping_measures(c.pings, c.p), c.events, c.p))


OPERATORS = {
    "ping_pass": lambda c: ping_pass(c.clean, c.p),
    "shift_features": lambda c: shift_features(c.pings, c.p),
    "stop_events": lambda c: stop_events(c.pings, c.p),
    "loading_events": lambda c: confirmed_loads(nearest_loaders(close_pairs(load_candidates(stop_events(c.pings, c.p), c.p), c.loaders, c.p), c.loaders, c.p), c.p),
    "body_up_events": lambda c: body_up_events(c.pings, c.fleet_cls, c.p),
    "geofence_events": lambda c: geofence_events(dump_candidates(stop_events(c.pings, c.p), c.p), c.fleet_cls, c.inp.zones, c.p),
    "trip_state": state,
    "trip_aggregate": lambda c: trip_aggregate(state(c), c.p),
    "cycle_times": lambda c: cycle_times(state(c)),
    "sequences": lambda c: sequence_rows(c.pings, c.p),
}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_no_python_or_nested_loops(ctx, name):
    p = plan(OPERATORS[name](ctx))
    assert "FileScan" in p, "the plan must start at the files"
    for bad in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in p, (name, bad)


def chains(p: str, table: str = "pings_") -> list[list[str]]:
    """For each scan of the ping table the nodes above it, the lowest first."""
    nodes = [(len(re.match(r"[\s:|+\-]*", x)[0]), x.strip(" :+-|")) for x in p.splitlines() if x.strip()]
    out = []
    for i, (depth, text) in enumerate(nodes):
        if text.startswith(("FileScan", "*")) and "FileScan" in text and table in text:
            up = [text]
            for d, t in reversed(nodes[:i]):
                if d < depth:
                    up.append(t)
                    depth = d
            out.append(up)
    return out


@pytest.mark.parametrize("name", ["shift_features", "trip_state", "trip_aggregate", "sequences"])
def test_no_exchange_of_the_ping_table(ctx, name):
    """Pings are laid out by vehicle and time bucket: only partial aggregates of them are shuffled."""
    found = chains(plan(OPERATORS[name](ctx)))
    assert found
    for up in found:
        at = next((i for i, t in enumerate(up) if t.startswith("Exchange")), len(up))
        assert at == len(up) or any("Aggregate(" in t for t in up[:at]), up[:at + 1]
    if name != "shift_features":  # the windows run on the layout as it lies in the files
        assert any("Window" in t for up in found for t in up) and any("Bucketed: true" in up[0] for up in found)


def test_the_layout_is_needed(ctx):
    """Without the layout the same pass shuffles the pings: the test above can fail."""
    loose = ctx.pings.repartition(3)
    p = plan(sequence_rows(loose, ctx.p))
    assert re.search(r"Exchange hashpartitioning\(vehicle#\d+, _bkt#\d+", p)


def test_shift_aggregate_reads_only_needed_columns(ctx):
    p = plan(shift_aggregate(ping_measures(ctx.pings, ctx.p), ctx.p))
    for schema in re.findall(r"ReadSchema: struct<([^>]*)>", p):
        names = {c.split(":")[0] for c in schema.split(",")}
        assert "longitude" not in names and "utm_x" not in names and "fuel_volume" not in names


def test_class_filter_reaches_the_scan_of_written_files(spark, ctx, tmp_path):
    from fleetspark.operators.clean import clean_loaders
    from fleetspark.sources.telemetry import read_telemetry
    ctx.inp.telemetry.drop("ts_us").write.parquet(f"{tmp_path}/t")
    p = plan(clean_loaders(read_telemetry(spark, f"{tmp_path}/t"), ctx.p))
    schema = re.search(r"ReadSchema: struct<([^>]*)>", p)[1]
    assert {c.split(":")[0] for c in schema.split(",")} == {"vehicle", "ts", "altitude", "utm_x", "utm_y", "ping_id"}


def test_asof_is_equi_join_on_bins(spark):
    p = plan(E.queries()["loader_asof"](spark, SF_SMALL))
    assert "_bin" in p and "NestedLoop" not in p


def test_sequence_labels_do_not_replay_the_sequences(ctx):
    p = plan(ctx.seq_labels)
    assert "pings_" not in p and "Window" not in p
