import os
import uuid

import pytest

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.exists(SF), reason="driver tables not present")
def test_raw_roundtrip_keeps_schema(spark):
    from ledgerline import schemas as S
    from ledgerline.session import scratch_dir
    from ledgerline.sources.adapters import RawTables
    from ledgerline.sources.raw import read_raw, write_raw
    path = scratch_dir(spark, f"test-raw-{uuid.uuid4().hex[:8]}")
    src = RawTables(spark, SF).tenants()
    write_raw(src, path, "raw_tenants")
    back = read_raw(spark, path, "raw_tenants")
    assert [f.name for f in back.schema] == [n for n, _ in S.RAW_TENANTS]
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, src.collect()))
