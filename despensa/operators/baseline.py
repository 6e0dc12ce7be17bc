"""Additive baseline of every product: trend with bends, short seasonality, holiday effects.

A group is one product's weekly rows, a few hundred at most, so fitting is a small dense solve per
group and products are spread over the cluster. The fit is penalised least squares; its numbers are
not those of a sampled model, the shape, clipping, bands and repeatability are the contract.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from despensa.functions.numbers import num_recorte
from despensa.soporte import enviar_por_valor

enviar_por_valor(__name__)

# ---- fixed values: search ranges (name, low, high, log scale) and settings ----
RANGOS = [("changepoint_prior_scale", 0.001, 0.5, True),
          ("seasonality_prior_scale", 0.01, 20.0, True),
          ("holidays_prior_scale", 1.0, 30.0, False),
          ("changepoint_range", 0.70, 0.95, False)]
MODOS = ["additive", "multiplicative"]
POR_DEFECTO = {"changepoint_prior_scale": 0.05, "seasonality_prior_scale": 10.0,
               "holidays_prior_scale": 10.0, "changepoint_range": 0.8,
               "seasonality_mode": "additive"}
PERIODO, ORDEN = 24.0, 5
QUIEBRES = 25
FALLO = 9999.0
Z80 = 1.2815515655446004
# Solves of the bends' prior, and below which share of its scale a bend counts as none.
VUELTAS, CASI_CERO = 12, 1e-3
# -------------------------------------------------------------------------------

ESQUEMA_PARAMS = ("changepoint_prior_scale double, seasonality_prior_scale double, "
                  "holidays_prior_scale double, changepoint_range double, seasonality_mode string")
COLS_PARAMS = [c.split()[0] for c in ESQUEMA_PARAMS.split(", ")]


def pruebas_base(n: int = 20, semilla: int = 42) -> list[dict]:
    """Seeded draws from the search ranges, the trial table."""
    g = np.random.default_rng(semilla)
    salida = []
    for i in range(n):
        p = {"prueba": i}
        for nombre, lo, hi, log in RANGOS:
            u = g.uniform(np.log(lo), np.log(hi)) if log else g.uniform(lo, hi)
            p[nombre] = float(np.exp(u) if log else u)
        p["seasonality_mode"] = MODOS[int(g.integers(2))]
        salida.append(p)
    return salida


def jn_busqueda(claves: DataFrame, pruebas: Sequence[dict]) -> DataFrame:
    """Every key with every trial: the trials, a short list, are exploded from a literal array."""
    filas = F.array(*[F.struct(*[F.lit(v).alias(k) for k, v in p.items()]) for p in pruebas])
    return claves.select(*claves.columns, F.inline(filas))


def efectos(dias: np.ndarray, festivos: Sequence, visto: np.ndarray, periodo: float = PERIODO,
            orden: int = ORDEN) -> tuple[np.ndarray, int]:
    """Seasonal and holiday columns of one series; holidays no observed row has are left out."""
    fase = 2 * np.pi * dias[:, None] * np.arange(1, orden + 1)[None, :] / periodo
    conjuntos = [frozenset(f) for f in festivos]
    nombres = sorted(frozenset().union(*(f for f, v in zip(conjuntos, visto) if v)))
    marca = np.zeros((len(dias), len(nombres)))
    lugar = {h: j for j, h in enumerate(nombres)}
    for i, f in enumerate(conjuntos):
        for h in f & lugar.keys():
            marca[i, lugar[h]] = 1.0
    return np.column_stack([np.sin(fase), np.cos(fase), marca]), len(nombres)


def tendencia(dias: np.ndarray, visto: np.ndarray, rango: float, quiebres: int = QUIEBRES) -> np.ndarray:
    """Level, slope and the bends spread evenly over the first ``rango`` of the history."""
    ini, fin = dias[visto][0], dias[visto][-1]
    t = (dias - ini) / max(fin - ini, 1)
    tv = t[visto]
    corte = max(int(len(tv) * rango) - 1, 1)
    k = min(quiebres, corte)
    s = tv[np.linspace(0, corte, k + 1).round().astype(int)[1:]]
    return np.column_stack([np.ones_like(t), t, np.clip(t[:, None] - s[None, :], 0, None)])


def _resolver(x: np.ndarray, y: np.ndarray, pena: np.ndarray, var: float) -> np.ndarray:
    return np.linalg.solve(x.T @ x + np.diag(pena * var), x.T @ y)


def _laplace(quiebres: np.ndarray, escala: float) -> np.ndarray:
    """Squared penalty that stands for a Laplace prior near these bends: small ones are held at 0, large
    ones let go."""
    return 1 / (escala * np.maximum(np.abs(quiebres), CASI_CERO * escala))


def ajustar(dias: np.ndarray, y: np.ndarray, efec: np.ndarray, n_fest: int, p: dict, quiebres: int = QUIEBRES,
            pena: float = 1.0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Fitted values of all rows (rows with null y are forecast), the spread of each row, the bends.

    Bends have a Laplace prior, found by solving anew with the penalty of the last bends; season
    and holidays a normal one. ``pena`` scales the penalty of every part; 0 is a plain least-squares fit. After
    the last observed row the spread grows: bends as frequent and as large as those of the history may follow.
    """
    visto = ~np.isnan(y)
    escala = max(np.abs(y[visto]).max(), 1e-9)
    v = y[visto] / escala
    tend = tendencia(dias.astype(float), visto, p["changepoint_range"], quiebres)
    n_q, ancho = tend.shape[1] - 2, p["changepoint_prior_scale"]
    pena_t = pena * np.r_[1 / 25.0, 1 / 25.0, np.full(n_q, 1 / ancho ** 2)]
    pena_e = pena * np.r_[np.full(efec.shape[1] - n_fest, 1 / p["seasonality_prior_scale"] ** 2),
                          np.full(n_fest, 1 / p["holidays_prior_scale"] ** 2)]
    var = max(v.var(), 1e-6)
    e = np.zeros(len(dias))
    for _ in range(VUELTAS if n_q and pena else 3):
        if p["seasonality_mode"] == "additive":
            x, junta = np.column_stack([tend, efec]), np.r_[pena_t, pena_e]
            b = _resolver(x[visto], v, junta, var)
            ajuste, b = x @ b, b[:tend.shape[1]]
        else:
            # y = trend * (1 + effects): each part in turn, the other held.
            m = (1 + e)[:, None] * tend
            b = _resolver(m[visto], v, pena_t, var)
            g = tend @ b
            x = g[:, None] * efec
            e = efec @ _resolver(x[visto], v - g[visto], pena_e, var)
            ajuste = g * (1 + e)
        var = max(np.mean((v - ajuste[visto]) ** 2), 1e-6)
        pena_t[2:] = pena * _laplace(b[2:], ancho)
    resto = float(np.mean((v - ajuste[visto]) ** 2))
    t = tend[:, 1]
    # Variance that bends at this rate, of this mean size, put into the trend by then.
    futuro = np.clip(t - t[visto][-1], 0, None)
    banda = np.sqrt(resto + 2 * n_q * float(np.mean(np.abs(b[2:])) if n_q else 0.0) ** 2 * futuro ** 3 / 3)
    return ajuste * escala, banda * escala, b[2:]


def ajustar_serie(dias: np.ndarray, y: np.ndarray, efec: np.ndarray, n_fest: int, p: dict,
                  quiebres: int = QUIEBRES, pena: float = 1.0) -> tuple[np.ndarray, float]:
    """Fitted values of all rows and the residual spread."""
    ajuste, banda, _ = ajustar(dias, y, efec, n_fest, p, quiebres, pena)
    return ajuste, float(banda[~np.isnan(y)][0])


def _dias(ds: pd.Series) -> np.ndarray:
    return pd.to_datetime(ds).to_numpy().astype("datetime64[D]").astype("int64")


def repartir(d: DataFrame) -> DataFrame:
    """Products over all task slots. Left to itself the shuffle would be merged by its size in
    bytes, which is tiny next to the work in each group."""
    spark = d.sparkSession
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")),
            spark.sparkContext.defaultParallelism)
    return d.repartition(n, "producto")


def con_festivos(serie: DataFrame, semanas: DataFrame, *extra: str, festivos: bool = True) -> DataFrame:
    """Holidays that fall on each Monday, from the weekly calendar (one row a week); none if not wanted."""
    if not festivos:
        return serie.select("producto", "ds", "y", *extra, F.array().cast("array<string>").alias("festivos"))
    return serie.select("producto", "ds", "y", *extra).join(
        F.broadcast(semanas.select("ds", "festivos")), "ds", "left")


def ts_base(serie: DataFrame, semanas: DataFrame, parametros: DataFrame | None = None,
            periodo: float = PERIODO, orden: int = ORDEN, entero: bool = True, quiebres: int = QUIEBRES,
            pena: float = 1.0, festivos: bool = True) -> DataFrame:
    """Baseline yhat with its 80 % band for every row of ``serie``; rows with null y are forecast.

    ``parametros`` holds one row per product; without it the default settings are used. Results
    are never negative and, with ``entero``, rounded up to whole units. Without bends, season (order 0),
    holidays and penalty it is the least-squares line.
    """
    d = con_festivos(serie, semanas, festivos=festivos)
    if parametros is None:
        d = d.withColumns({k: F.lit(v) for k, v in POR_DEFECTO.items()})
    else:
        d = d.join(parametros.select("producto", *COLS_PARAMS), "producto")

    def de_grupo(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values("ds")
        p = g.iloc[0][COLS_PARAMS].to_dict()
        dias, y = _dias(g["ds"]), g["y"].to_numpy(float)
        efec, n_fest = efectos(dias, g["festivos"], ~np.isnan(y), periodo, orden)
        yhat, s, _ = ajustar(dias, y, efec, n_fest, p, quiebres, pena)
        return pd.DataFrame({"producto": g["producto"].to_numpy(), "ds": g["ds"].to_numpy(),
                             "yhat": yhat, "yhat_lower": yhat - Z80 * s,
                             "yhat_upper": yhat + Z80 * s})

    r = repartir(d).groupBy("producto").applyInPandas(
        de_grupo, "producto string, ds date, yhat double, yhat_lower double, yhat_upper double")
    cero = F.lit(0.0)
    return r.withColumns({c: num_recorte(c).cast("double") if entero else F.greatest(F.col(c), cero)
                          for c in ("yhat", "yhat_lower", "yhat_upper")})


def ts_ajuste_base(partes: DataFrame, semanas: DataFrame, pruebas: Sequence[dict], orden: int = ORDEN,
                   quiebres: int = QUIEBRES, pena: float = 1.0, festivos: bool = True) -> DataFrame:
    """Error of every trial for every product: fitted on the rows with ``parte = 'train'``, scored
    on the active weeks of the rest. A trial that cannot be scored gets 9999.

    All trials of a product run where its rows are, so the series is shuffled once, not once per
    trial.
    """
    lista = list(pruebas)
    d = con_festivos(partes, semanas, "parte", festivos=festivos)

    def buscar(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values("ds")
        y, dias = g["y"].to_numpy(float), _dias(g["ds"])
        ent = (g["parte"] == "train").to_numpy()
        activa = ~ent & (y > 0)
        efec, n_fest = efectos(dias, g["festivos"], ent, orden=orden)
        filas = []
        for p in lista:
            mae = FALLO
            if activa.any() and ent.sum() > 2:
                try:
                    yhat, _ = ajustar_serie(dias, np.where(ent, y, np.nan), efec, n_fest, p, quiebres, pena)
                    mae = float(np.abs(np.ceil(np.clip(yhat, 0, None)) - y)[activa].mean())
                except np.linalg.LinAlgError:
                    mae = FALLO
            filas.append({"producto": g["producto"].iloc[0], **p, "mae": mae})
        return pd.DataFrame(filas)[["producto", "prueba", *COLS_PARAMS, "mae"]]

    return repartir(d).groupBy("producto").applyInPandas(
        buscar, f"producto string, prueba int, {ESQUEMA_PARAMS}, mae double")


def ts_base_anual(serie: DataFrame, semanas: DataFrame, futuras: int = 26, orden: int = 10, **como) -> DataFrame:
    """Baseline of the exploratory variant: yearly season of order 10, half a year ahead, 0 where a
    week sold nothing. ``semanas`` must reach as far."""
    from despensa.operators.series import set_expandir, ts_cero
    r = ts_base(set_expandir(serie, futuras), semanas, periodo=365.25, orden=orden, entero=False, **como)
    return ts_cero(r.join(serie, ["producto", "ds"], "left"), F.col("y") == 0, ("yhat",))


def agg_mejor_prueba(pruebas: DataFrame, *cols: str) -> DataFrame:
    """Trial with the least error per product, the earliest on a tie."""
    orden = F.struct("mae", "prueba")
    return pruebas.groupBy("producto").agg(
        F.min_by("prueba", orden).alias("prueba"), F.min("mae").alias("mae"),
        *[F.min_by(c, orden).alias(c) for c in cols])
