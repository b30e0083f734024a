"""The command line, in a process of its own and away from the repository folder."""

import os
import subprocess
import sys
from pathlib import Path

REPO = Path(__file__).resolve().parent.parent
HEADER = (
    "FECHA_CORTE;PERIODO;COD_CONTRIBUYENTE;NOM_CONTRIBUYENTE;COD_PREDIO;PORCENTAJE_CONDOMINIO;"
    "MONTO_PARQUE_JARDIN;MONTO_SERENAZGO;MONTO_RESIDUO_SOLIDO;MONTO_BARRIDO_CALLE;"
    "DESCUENTO_TOPE_PARQUE_JARDIN;DESCUENTO_TOPE_SERENAZGO;MONTO_TOPE_RESIDUO_SOLIDO;"
    "DESCUENTO_TOPE_BARRIO_CALLE;DEPARTAMENTO;PROVINCIA;DISTRITO;UBIGEO"
)
ROWS = [
    "20250131;2025;T1;OLD NAME;P1;100;10.00;1,257.60;20.00;5.00;1.00;0.60;2.00;;D;P;X;010101",
    "20250131;2025;T1;OLD NAME;P1;100;10.00;1,257.60;20.00;5.00;1.00;0.60;2.00;;D;P;X;010101",
    "20250131;2025;T2;OTHER;P2;100;10.00;1,000.00;20.00;5.00;1.00;0.00;2.00;3.00;D;P;X;010101",
    "20240131;2024;T1;OLDEST NAME;P1;50;10.00;900.00;20.00;5.00;1.00;0.60;2.00;0.00;D;P;X;010101",
    "20250630;2025;T1;NEW NAME;P3;50;10.00;900.00;20.00;5.00;1.00;0.60;2.00;0.00;D;P;X;010101",
]


def run(job: str, folder: Path) -> None:
    subprocess.run(
        [sys.executable, "-m", "levyflow", str(folder / "in.csv"), str(folder / "out"), job],
        check=True, timeout=300, cwd=folder, env={**os.environ, "PYTHONPATH": str(REPO)},
    )


def test_etl_and_reports_from_the_command_line(spark, tmp_path):
    (tmp_path / "in.csv").write_text("\n".join([HEADER, *ROWS]) + "\n")
    run("etl", tmp_path)
    run("sql", tmp_path)
    out = tmp_path / "out"
    names = spark.read.json(str(out / "tables/contribuyentes.json")).collect()
    assert {(r["COD_CONTRIBUYENTE"], r["NOM_CONTRIBUYENTE"]) for r in names} == {
        ("T1", "NEW NAME"), ("T2", "OTHER"),
    }
    assert spark.read.json(str(out / "tables/emisiones.json")).count() == 4
    summary = spark.read.json(str(out / "queries/query1_groupby_periodo.json")).collect()
    assert [(r["PERIODO"], r["num_emisiones"], r["total_serenazgo"], r["avg_serenazgo"]) for r in summary] == [
        (2024, 1, 900.0, 900.0), (2025, 3, 3157.6, 1052.53),
    ]
    # The net of P1 is null, for want of one discount, and comes last.
    [part] = (out / "queries/query2_top_predios_2025.json").glob("part-*.json")
    assert part.read_text().splitlines() == [
        '{"COD_PREDIO":"P2","COD_CONTRIBUYENTE":"T2","PERIODO":2025,"monto_total_neto":1029.0}',
        '{"COD_PREDIO":"P1","COD_CONTRIBUYENTE":"T1","PERIODO":2025}',
    ]
