"""End-to-end jobs from files (FIXTURES.md 6 edge rows through the real
readers and writers)."""

import os
import tempfile

from tabkit import jobs
from tabkit.operators import claims as C


def _write(path, lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as fh:
        fh.write("\n".join(lines) + "\n")


def _claims_files(root):
    _write(f"{root}/claims/claims.txt", ["|".join(C.CLAIM_COLUMNS),
                                          "R1|cli1|1|c|cf|cc|id|td|nd|seg", "R2|cli2|02|c|cf|cc|id|td|nd|seg"])
    _write(f"{root}/cat/cat.txt", ["CODE_OPER|DESCRIPTION", "10|TEN", "11|"])


def test_mobile_job(spark):
    root = tempfile.mkdtemp(prefix="tabkit-job-")
    _claims_files(root)
    _write(f"{root}/calls/20240110/n1/a.DAT", [
        "20240110|1200|O|60|1|2|10|5|S", "20240110|1200|O|60|2|2|11|5|V",
        "20240110|1200|O|60||1|12|5|S", "20240110|1200|O|60|9|8|10|5|S", "20240110|1200|O|60|1|2|10|5|X"])
    _write(f"{root}/calls/20240112/n1/a.DAT", ["20240112|0900|I|30| 9 | 01 |10|5| S "])
    detail, skipped = jobs.mobile_claims_job(spark, f"{root}/claims/claims.txt", f"{root}/cat/cat.txt",
                                             f"{root}/calls", "2024-01-12", 0, out_path=None)
    assert skipped.count() == 0
    detail, skipped = jobs.mobile_claims_job(spark, f"{root}/claims/claims.txt", f"{root}/cat/cat.txt",
                                             f"{root}/calls", "2024-01-15", 1, out_path=f"{root}/out",
                                             archive_dir=f"{root}/processed/20240115")
    assert skipped.count() == 32 - 2
    rows = spark.read.option("sep", "|").csv(f"{root}/out").collect()
    got = sorted((r[1], r[13] or "<null>") for r in rows)   # claim id, operator description
    # (1,2)->R1,R2 ; (2,2)->R2 ; (NULL,1)->R1 ; (9,1 from ' 01 ')->R1 ; 11 has empty description -> NULL
    assert got == sorted([("R1", "TEN"), ("R2", "TEN"), ("R2", "<null>"), ("R1", "12"), ("R1", "TEN")])
    assert os.path.exists(f"{root}/processed/20240115/claims.txt")
    assert not os.path.exists(f"{root}/claims/claims.txt")


def test_fixed_job_with_outgoing(spark):
    root = tempfile.mkdtemp(prefix="tabkit-fixed-")
    _claims_files(root)
    _write(f"{root}/in/fecha_comunicacion=2024-01-10/delta_1/p1", ["2024-01-10|10:00|E|60|1|7|10|0.5|U"])
    _write(f"{root}/in/fecha_comunicacion=2023-01-10/delta_1/p1", ["2023-01-10|10:00|S|60|1|7|10|0.5|U"])
    _write(f"{root}/out/X_20240111_a.DAT", ["2024-01-11,11:00,S,60,2,5,11,0.7,U"])
    d = jobs.fixed_claims_job(spark, f"{root}/claims/claims.txt", f"{root}/cat/cat.txt", f"{root}/in",
                              "2024-01-15", 1, out_path=f"{root}/res")
    # incoming (E): target 1 becomes the origin, origin 7 the destination
    assert [(r.ID_CORRELATIVO_RECLAMO, r.NUMERO_DESTINO) for r in d.collect()] == [("R1", "7")]
    d2 = jobs.fixed_claims_job(spark, f"{root}/claims/claims.txt", f"{root}/cat/cat.txt", f"{root}/in",
                               "2024-01-15", 1, outgoing_base=f"{root}/out")
    assert sorted(r.ID_CORRELATIVO_RECLAMO for r in d2.collect()) == ["R1", "R2"]
    back = spark.read.option("header", "true").option("sep", "|").csv(f"{root}/res")
    assert back.columns == C.DETAIL_COLUMNS and back.count() == 1
