"""Error events are decoded whole over the whole events table."""

import __spark_entry__ as entry
from conftest import SF_SMOKE


def test_error_messages_are_decoded_whole(spark):
    events = {r.event_id: r.event_type for r in spark.read.parquet(f"{SF_SMOKE}/events.parquet").select("event_id", "event_type").collect()}
    got = entry.queries()["envelope_decode_whole"](spark, SF_SMOKE).collect()
    errors = [i for i, t in events.items() if t == "error"]
    assert errors and len(got) == len(events) + len(errors)
    whole = {r.offset: r for r in got if r._error is None}
    assert {i: r.eventType for i, r in whole.items()} == events
    assert all(whole[i].eventId == str(i) and whole[i].event_ts and whole[i].source for i in errors)
    assert sum(r._error == "malformed" for r in got) == len(errors)
