"""Product-name cleaning and categorising as column expressions."""

from __future__ import annotations

import unicodedata
from collections.abc import Sequence
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values, as the results need them ----
PATRONES = [
    r"\([^\n]*\)", r"\p{Nd}+k", r"\p{Nd}+oz",
    "Mediana", "Mediano", "Grande", "Veggie",
    "400ml", "600ml", "250ml", "450ml",
]
CANONICOS = {
    "Hatsu amarillo": "Hatsu Amarillo",
    "Chocolate caliente": "Chocolate Caliente",
    "Pastel de pollo": "Pastel de Pollo",
    "Agua cristal": "Agua sin Gas",
    "Agua sin gas cristal": "Agua sin Gas",
    "Agua con gas cristal": "Agua con Gas",
    "Soda rosada": "Soda Hatsu Rosada",
    "Parfaits": "Parfait Frutos Rojos",
    "Parfaits frutos rojos": "Parfait Frutos Rojos",
}
PREFIJOS = ["sandwich ", "sándwich ", "bowl ", "ensalada ", "smoothie ", "pancakes "]
SUFIJOS = [" mediana", " mediano", " grande", " veggie mediana", " veggie grande",
           " (mediano)", " (grande)"]
REGLAS_PLATO = [
    ("Sándwich", ["sándwich", "sandwich"]),
    ("Bowl", ["bowl"]),
    ("Ensalada", ["ensalada"]),
    ("Pasta", ["pasta"]),
    ("Arma tu plato", ["arma tu plato"]),
    ("Desayuno", ["parfait", "pancake", "waffle", "yogurt", "granola", "tostada", "bagel",
                  "wake up", "bananabread", "choco"]),
    ("Bebida", ["smoothie", "jugo", "shot", "hatsu", "agua", "soda", "chocolate", "milo", "cafe",
                "café", "americano", "latte", "cappuccino"]),
    ("Sopa", ["sopa"]),
    ("Sándwich", ["pavoneta", "mexi", "rustico", "becha"]),
]
LOCALES = {"FV-1": "Principal", "FV-2": "Eventos", "FV-3": "Eventos", "FV-4": "CP"}
ALIAS = (["Arma tu plato Grande(21k)", "Arma tu plato mediano (18k)"], "Arma tu plato (combinado)")
# ------------------------------------------------

# White space as Python's str.split sees it, for Java and RE2 alike.
BLANCO = r"[\t-\r\x1c-\x20\x85\p{Z}]"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _colapsar(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, BLANCO + "+", " "))


def _mapa(d: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for par in d.items() for x in par])


def cln_nombre(c: Column | str, capitalizar: bool = False) -> Column:
    """Product name without sizes, prices and volumes, in its canonical spelling."""
    original = _c(c)
    limpio = original
    for p in PATRONES:
        limpio = F.regexp_replace(limpio, "(?iu)" + p, "")
    limpio = _colapsar(limpio)
    limpio = F.coalesce(F.try_element_at(_mapa(CANONICOS), limpio), limpio)
    final = limpio
    if capitalizar:
        final = F.concat(F.upper(F.substring(limpio, 1, 1)),
                         F.lower(F.substr(limpio, F.lit(2))))
    return F.when(F.length(limpio) > 0, final).otherwise(original)


@cache
def tabla_acentos() -> tuple[str, str]:
    """Letters that are a plain letter plus combining marks, and those plain letters."""
    con, sin = [], []
    for cp in (*range(0x00C0, 0x0530), *range(0x1E00, 0x2000)):
        ch = chr(cp)
        base = "".join(x for x in unicodedata.normalize("NFD", ch)
                       if unicodedata.category(x) != "Mn")
        if len(base) == 1 and base != ch:
            con.append(ch)
            sin.append(base)
    return "".join(con), "".join(sin)


def cln_acentos(c: Column | str) -> Column:
    """Lower case, no accents, single spaces; null gives ''."""
    con, sin = tabla_acentos()
    s = F.translate(F.lower(_c(c)), con, sin)
    return F.coalesce(_colapsar(F.regexp_replace(s, r"\p{Mn}", "")), F.lit(""))


def cln_venta(c: Column | str) -> Column:
    """Sale name made comparable to recipe names: no price, no parentheses, no leading type."""
    prefijos = "|".join(PREFIJOS)
    s = F.trim(F.regexp_replace(cln_acentos(c), r"\([^\n]*?\)", ""))
    return F.trim(F.regexp_replace(s, f"^(?:{prefijos})", ""))


def cln_variantes(c: Column | str) -> Column:
    """Ordered distinct spellings to look a sale name up by."""
    s = cln_acentos(c)
    nada = F.lit(None).cast("string")
    cortes = [
        F.when(F.endswith(s, F.lit(x)), F.trim(F.left(s, F.length(s) - len(x)))).otherwise(nada)
        for x in SUFIJOS
    ]
    genero = [
        F.when(F.contains(s, F.lit(a)), F.replace(s, F.lit(a), F.lit(b))).otherwise(nada)
        for a, b in (("mediano", "mediana"), ("mediana", "mediano"))
    ]
    return F.array_distinct(F.filter(F.array(s, *cortes, *genero), lambda v: v.isNotNull()))


def cat_plato(c: Column | str, reglas: Sequence[tuple[str, Sequence[str]]] = REGLAS_PLATO,
              resto: str = "Otros") -> Column:
    """First category of the ordered rules one of whose words the name contains."""
    n = F.lower(F.coalesce(_c(c), F.lit("nan")))
    fuera = None
    for categoria, palabras in reglas:
        hay = F.contains(n, F.lit(palabras[0]))
        for p in palabras[1:]:
            hay = hay | F.contains(n, F.lit(p))
        fuera = F.when(hay, categoria) if fuera is None else fuera.when(hay, categoria)
    return fuera.otherwise(resto)


def cat_local(c: Column | str, locales: dict[str, str] = LOCALES) -> Column:
    """Location a document prefix stands for, else null."""
    return F.try_element_at(_mapa(locales), _c(c))


def cat_alias(c: Column | str, nombres: Sequence[str] = ALIAS[0], uno: str = ALIAS[1]) -> Column:
    """Several product names as one."""
    return F.when(_c(c).isin(*nombres), uno).otherwise(_c(c))
