"""All registered queries."""

from despensa.plans import (  # noqa: F401
    calendario, fuentes, limpieza, modelos, panel, segmentacion, series,
)
from despensa.plans.registro import CONSULTAS, SQL  # noqa: F401
