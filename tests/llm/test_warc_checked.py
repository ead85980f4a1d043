"""The archive query rebuilds and checks every record."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from cardlake.llm import queries, warc


def test_archive_query_fails_on_a_wrong_header_digest(spark, monkeypatch):
    read = warc.read_archive
    assert queries.op6_warc_archive(spark, "/root/testdata/sf0.001").count() > 0
    monkeypatch.setattr(warc, "read_archive", lambda *a: read(*a).withColumn("verified", F.col("verified") & (F.col("page_id") % 7 != 0)))
    with pytest.raises(Exception, match="not whole"):
        queries.op6_warc_archive(spark, "/root/testdata/sf0.001").collect()
