"""Column roles and output names of the levy billing data set.

Every operator takes column names as arguments; this is the only place where the
data set's own names live.
"""

from __future__ import annotations

from dataclasses import dataclass

# --- fixed values: column names, output names and training settings of the data set ---
RAW_COLUMNS = (
    "FECHA_CORTE",
    "PERIODO",
    "COD_CONTRIBUYENTE",
    "NOM_CONTRIBUYENTE",
    "COD_PREDIO",
    "PORCENTAJE_CONDOMINIO",
    "MONTO_PARQUE_JARDIN",
    "MONTO_SERENAZGO",
    "MONTO_RESIDUO_SOLIDO",
    "MONTO_BARRIDO_CALLE",
    "DESCUENTO_TOPE_PARQUE_JARDIN",
    "DESCUENTO_TOPE_SERENAZGO",
    "MONTO_TOPE_RESIDUO_SOLIDO",
    "DESCUENTO_TOPE_BARRIO_CALLE",
    "DEPARTAMENTO",
    "PROVINCIA",
    "DISTRITO",
    "UBIGEO",
)

AMOUNTS = (
    "MONTO_PARQUE_JARDIN",
    "MONTO_SERENAZGO",
    "MONTO_RESIDUO_SOLIDO",
    "MONTO_BARRIDO_CALLE",
)

DISCOUNTS = (
    "DESCUENTO_TOPE_PARQUE_JARDIN",
    "DESCUENTO_TOPE_SERENAZGO",
    "MONTO_TOPE_RESIDUO_SOLIDO",
    "DESCUENTO_TOPE_BARRIO_CALLE",
)

FACT_COLUMNS = (
    "FECHA_CORTE",
    "PERIODO",
    "COD_PREDIO",
    "COD_CONTRIBUYENTE",
    "PORCENTAJE_CONDOMINIO",
    "MONTO_PARQUE_JARDIN",
    "MONTO_SERENAZGO",
    "MONTO_RESIDUO_SOLIDO",
    "MONTO_BARRIDO_CALLE",
    "DESCUENTO_TOPE_PARQUE_JARDIN",
    "DESCUENTO_TOPE_SERENAZGO",
    "MONTO_TOPE_RESIDUO_SOLIDO",
    "DESCUENTO_TOPE_BARRIO_CALLE",
    "UBIGEO",
)

REGRESSION_FEATURES = (
    "PERIODO",
    "PORCENTAJE_CONDOMINIO",
    "MONTO_PARQUE_JARDIN",
    "MONTO_RESIDUO_SOLIDO",
    "MONTO_BARRIDO_CALLE",
    "DESCUENTO_TOPE_PARQUE_JARDIN",
    "MONTO_TOPE_RESIDUO_SOLIDO",
    "DESCUENTO_TOPE_BARRIO_CALLE",
)

REPORT_SUFFIXES = {
    "MONTO_PARQUE_JARDIN": "parque_jardin",
    "MONTO_SERENAZGO": "serenazgo",
    "MONTO_RESIDUO_SOLIDO": "residuo_solido",
    "MONTO_BARRIDO_CALLE": "barrido_calle",
}

REPORT_COUNT, REPORT_NET = "num_emisiones", "monto_total_neto"
SUMMARY_NAME, TOP_NAME = "query1_groupby_periodo", "query2_top_predios"
MLP_NAME, SVR_NAME = "MLPRegressor", "SVRegressor"
CURVE_NAMES = {"MLPRegressor": "mlp_regressor", "SVRegressor": "svr_regressor"}
FOREST_NAME, PERCEPTRON_NAME = "RandomForest", "MLPClassifier"

EXCLUSIVE_LABEL, SHARED_LABEL = "Exclusivo", "Compartido"

MLP_HIDDEN, MLP_EPOCHS, MLP_RATE = 16, 100, 0.05
SVR_EPOCHS, SVR_RATE, SVR_EPSILON, SVR_L2 = 400, 0.2, 0.1, 1e-4
FOREST_TREES, FOREST_DEPTH = 100, 8
PERCEPTRON_HIDDEN, PERCEPTRON_ITERATIONS = (8, 4), 200
TRAIN_PERCENT, SEED = 80, 42
TOP_K, REPORT_PERIOD = 20, 2025
# --- end of fixed values ---


@dataclass(frozen=True)
class LevyConfig:
    """Which column plays which role, and how tables are stored."""

    delimiter: str = ";"
    cut_date: str = "FECHA_CORTE"
    period: str = "PERIODO"
    taxpayer: str = "COD_CONTRIBUYENTE"
    taxpayer_name: str = "NOM_CONTRIBUYENTE"
    property_id: str = "COD_PREDIO"
    share: str = "PORCENTAJE_CONDOMINIO"
    amounts: tuple[str, ...] = AMOUNTS
    discounts: tuple[str, ...] = DISCOUNTS
    fact_columns: tuple[str, ...] = FACT_COLUMNS
    features: tuple[str, ...] = REGRESSION_FEATURES
    regression_label: str = "MONTO_SERENAZGO"
    class_label: str = "TIPO_PREDIO"
    dimension_table: str = "contribuyentes"
    fact_table: str = "emisiones"
    # The first format is the one later jobs read back; the others are exports of it.
    table_formats: tuple[str, ...] = ("parquet", "json")
    on_error: str = "fail"
    # Whether commas may only group thousands.
    strict_numbers: bool = False

    @property
    def decimals(self) -> tuple[str, ...]:
        return (self.share, *self.amounts, *self.discounts)

    @property
    def integers(self) -> tuple[str, ...]:
        return (self.cut_date, self.period)

    @property
    def fact_key(self) -> tuple[str, ...]:
        return (self.property_id, self.taxpayer, self.period)

    @property
    def class_features(self) -> tuple[str, ...]:
        # The class label is computed from the share, so the share may not be a feature.
        return tuple(c for c in self.features if c != self.share)
