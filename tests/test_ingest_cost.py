"""What an ingest parses and writes only once, or small."""

import glob

from tidemark.plans import load_queries
from tidemark.plans.ingest_queries import gated
from tidemark.session import Tables
from tests.test_plans import PATH, plan


def test_a_batch_is_parsed_once_for_its_drift(spark):
    """Verdicts are made of the written profile; no event is parsed, and none shuffled, for them."""
    job = gated(Tables(spark, PATH))
    good = job.events(spark).filter("batch = 0")
    text = plan(job._drift(good, 99))
    assert "get_json_object" not in text and "from_json" not in text
    assert len(glob.glob(f"{job.path.removeprefix('file:')}/profile/batch=*")) == 4  # the three batches and the one above


def test_landed_feed_is_compressed_and_dealt_before_it_is_made(spark):
    before = set(glob.glob(_shared(spark) + "/landing-*"))
    assert load_queries()["stream_dedupe_and_gate"].build(Tables(spark, PATH)).count() > 0
    (new,) = set(glob.glob(_shared(spark) + "/landing-*")) - before
    files = glob.glob(new + "/*.json*")
    assert files and all(f.endswith(".json.gz") for f in files)


def _shared(spark):
    from tidemark.session import scratch_path

    return scratch_path(spark, "x").rsplit("/", 1)[0].removeprefix("file:")
