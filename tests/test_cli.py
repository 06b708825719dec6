"""Command line: load a landing directory, then query the stored warehouse."""

import os

from carelake.__main__ import main
from carelake.constants import ENGINEER_ROLE
from carelake.schemas import RAW_COLUMNS
from carelake.warehouse import Warehouse


def test_load_then_query(spark, wh_small, tmp_path, capsys):
    landing, root = str(tmp_path / "landing"), str(tmp_path / "wh")
    os.makedirs(landing)
    for d in ("patients", "appointments", "billing"):
        pdf = wh_small.resolve(f"raw_{d}").select(*RAW_COLUMNS[d]).toPandas()
        pdf.columns = [c.upper() for c in pdf.columns]
        pdf.to_csv(os.path.join(landing, f"{d}_2025.csv"), index=False)
    assert main(["load", landing, root]) == 0
    stored = Warehouse.from_storage(spark, root, role=ENGINEER_ROLE)
    for d in ("patients", "appointments", "billing"):
        assert stored.table(f"core_{d}").count() == wh_small.table(f"core_{d}").count()
    assert main(["query", root, "payer_mix"]) == 0
    assert "Self-Pay" in capsys.readouterr().out
