import datetime

from pyspark.sql import functions as F

from kinfold.operators import matching
from kinfold import api

FEED = "vendor string, record_id string, first_name string, last_name string, dob string, gender string, ssn string"


def test_every_new_record_is_looked_up_by_all_keys_and_gets_an_identity(spark):
    # 1100 core records share a block; SSN is all that links 'bySsn'.
    day = lambda i: (datetime.date(1980, 1, 1) + datetime.timedelta(i % 360)).isoformat()
    core = [("VENDOR_A", f"{i:08}", f"A{chr(65 + i % 26)}{chr(65 + i // 26 % 26)}{chr(65 + i // 676)}", "HOTTE", day(i), "F", None) for i in range(1100)]
    core += [("VENDOR_A", "00002000", "MARIA", "LOPEZ", "1970-05-06", "F", "123-45-6789")]
    new = [("VENDOR_A", "hot", *core[7][2:]), ("VENDOR_A", "bySsn", "MARIA", "SMITH", "1971-05-06", "F", "123456789"), ("VENDOR_A", "alone", "ZOE", "QUICK", "2001-02-03", "F", None), ("VENDOR_A", "blank", None, None, None, None, None), ("VENDOR_A", "blank2", None, None, None, None, None)]
    core, new = (matching.patient_normalized(spark.createDataFrame(rows, FEED)) for rows in (core, new))
    known = core.select("record_key", F.concat(F.lit("PGID"), F.lpad(F.substring("record_key", 10, 8), 12, "0")).alias("patient_global_id"), F.lit("run1").alias("first_seen_run"), F.lit("run1").alias("last_seen_run"))
    out = api.resolve(new, core, known).collect()
    got = {r.record_key.split(":")[1]: r for r in out}
    assert len(out) == len(got) == 5
    assert (got["hot"].outcome, got["hot"].patient_global_id) == ("matched", "PGID000000000007")
    assert got["bySsn"].match_score is not None and got["alone"].match_score is None and got["blank"].match_score is None
    minted = sorted(r.patient_global_id for r in out if r.outcome == "created")
    assert minted == [f"PGID{2001 + i:012}" for i in range(len(minted))] and {"alone", "blank", "blank2"} <= {k for k, r in got.items() if r.outcome == "created"}
    assert api.resolve(new.limit(0), core, known).count() == 0
    assert sorted(r.patient_global_id for r in api.resolve(new, core.limit(0), known.limit(0)).collect()) == [f"PGID{i:012}" for i in range(5)]
