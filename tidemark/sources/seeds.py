"""Values of the dictionaries, all of them fixed."""

from __future__ import annotations

# Terms of the ten families and their weights, fixed values. A term is given once, with its
# accents: terms are compared without them.
SEEDS: dict[str, dict[str, float]] = {
    "macro_fiscal": {"hacienda": 2.0, "ministerio_de_hacienda": 2.5, "presupuesto": 2.0, "deficit_fiscal": 2.5, "gasto_fiscal": 2.0, "politica_fiscal": 2.0, "subsidio": 1.3, "subsidio_electrico": 2.0, "impuestos": 2.0, "reforma tributaria": 2.5, "deuda pública": 2.0, "sueldo mínimo": 1.7},
    "mercado_financiero": {"banco_central": 3.0, "cmf": 2.5, "dólar": 2.5, "tipo_de_cambio": 3.0, "tasa_de_interes": 2.5, "ipc": 2.0, "inflación": 2.5, "imacec": 2.5, "bolsa": 2.0, "wall_street": 2.5, "renta_fija": 2.5, "renta_variable": 2.5, "bonos": 2.0, "acciones": 1.5, "mercado_financiero": 2.5},
    "energia_commodities": {"petróleo": 3.0, "cobre": 2.8, "litio": 2.5, "gas": 1.5, "combustibles": 2.0, "bencina": 1.7, "diésel": 1.7, "electricidad": 1.8, "tarifas eléctricas": 2.0, "enap": 2.5, "codelco": 2.5, "sqm": 2.2, "opep": 2.5},
    "empresas_instituciones": {"codelco": 2.5, "enap": 2.3, "sqm": 2.3, "cap": 1.8, "copec": 2.0, "falabella": 2.0, "cencosud": 2.0, "banco de chile": 2.0, "bci": 2.0, "itaú": 2.0, "cmf": 2.0, "banco_central": 2.0},
    "politico_regulatorio": {"proyecto de ley": 2.0, "proyecto_de_ley": 2.0, "congreso": 2.0, "senado": 1.8, "cámara": 1.8, "regulación": 2.0, "reforma": 1.7, "ley": 1.2, "gobierno": 1.0, "ejecutivo": 1.0, "hacienda": 1.5, "presupuesto": 1.5},
    "geopolitico_mercado": {"irán": 2.8, "israel": 2.0, "rusia": 2.5, "ucrania": 2.5, "china": 2.0, "estados_unidos": 1.8, "donald_trump": 1.8, "guerra": 1.2, "conflicto": 1.0, "estrecho_de_ormuz": 3.0, "aranceles": 2.5, "sanciones económicas": 2.3, "sanciones financieras": 2.3, "exportaciones": 1.5, "importaciones": 1.5, "cadena de suministro": 2.0},
    "riesgo_alerta": {"riesgo": 1.5, "crisis": 2.0, "alerta": 1.7, "incertidumbre": 2.0, "caída": 1.8, "desplome": 2.5, "recesión": 2.5, "conflicto": 1.5, "ataque": 1.5, "emergencia": 1.5, "quiebra": 2.5},
    "sentimiento_positivo": {"crecimiento": 1.5, "alza": 1.2, "sube": 1.2, "recuperación": 1.5, "mejora": 1.5, "acuerdo": 1.2, "inversión": 1.4, "expansión": 1.5},
    "sentimiento_negativo": {"caída": 1.5, "baja": 1.2, "crisis": 1.8, "riesgo": 1.4, "incertidumbre": 1.8, "desaceleración": 1.8, "pérdidas": 1.6, "quiebra": 2.2, "déficit": 1.5},
    "ruido_social": {"farándula": 1.5, "espectáculos": 1.5, "deportes": 1.5, "fútbol": 1.5, "policial": 1.0, "delito": 1.0, "detenido": 1.0, "música": 1.2, "cine": 1.2},
}
# Other names of the families, in the order in which they are searched, fixed values.
ALIASES = {
    "macro_fiscal": "macro_fiscal",
    "fiscal": "macro_fiscal",
    "hacienda": "macro_fiscal",
    "presupuesto": "macro_fiscal",
    "mercado_financiero": "mercado_financiero",
    "mercado": "mercado_financiero",
    "financial": "mercado_financiero",
    "financial_strict": "mercado_financiero",
    "bolsa": "mercado_financiero",
    "energia_commodities": "energia_commodities",
    "energia": "energia_commodities",
    "commodities": "energia_commodities",
    "commodity": "energia_commodities",
    "petroleo": "energia_commodities",
    "petróleo": "energia_commodities",
    "empresas_instituciones": "empresas_instituciones",
    "empresas": "empresas_instituciones",
    "instituciones": "empresas_instituciones",
    "companies": "empresas_instituciones",
    "company": "empresas_instituciones",
    "politico_regulatorio": "politico_regulatorio",
    "political": "politico_regulatorio",
    "political_risk": "politico_regulatorio",
    "regulatorio": "politico_regulatorio",
    "regulacion": "politico_regulatorio",
    "regulación": "politico_regulatorio",
    "geopolitico_mercado": "geopolitico_mercado",
    "geopolitico": "geopolitico_mercado",
    "geopolítico": "geopolitico_mercado",
    "geopolitical": "geopolitico_mercado",
    "geopolitical_market": "geopolitico_mercado",
    "riesgo_alerta": "riesgo_alerta",
    "riesgo": "riesgo_alerta",
    "alerta": "riesgo_alerta",
    "risk": "riesgo_alerta",
    "sentimiento_positivo": "sentimiento_positivo",
    "positivo": "sentimiento_positivo",
    "positive": "sentimiento_positivo",
    "sentimiento_negativo": "sentimiento_negativo",
    "negativo": "sentimiento_negativo",
    "negative": "sentimiento_negativo",
    "ruido_social": "ruido_social",
    "noise": "ruido_social",
    "social_noise": "ruido_social",
}
# Seed sets of the classes of articles, fixed values; a term is given once, with its accents.
CLASS_SEEDS: dict[str, tuple[str, ...]] = {
    "market": (
        "banco_central", "cmf", "mercado_financiero", "renta_fija", "renta_variable", "wall_street", "dólar", "tipo_de_cambio", "tasa_de_interes", "ipc", "inflación", "imacec",
        "actividad_economica", "recesión", "recesion_tecnica", "tpm", "politica_monetaria", "tasa_desempleo", "tasa_desocupacion", "mercado_laboral", "bolsa_valores", "bolsa_santiago",
        "bolsa_electronica_chile", "mercado_bursatil", "bonos_tesoro_eeuu", "bonos_soberanos", "bonos_corporativos", "dow_jones", "nasdaq", "nasdaq_100", "sp500", "reserva_federal", "fed",
    ),
    "fiscal": (
        "hacienda", "ministerio de hacienda", "ministro de hacienda", "presupuesto", "déficit fiscal", "gasto fiscal", "política fiscal", "subsidio eléctrico", "recursos públicos",
        "ley_presupuestos", "deuda_publica", "balance_fiscal", "regla_fiscal", "recaudacion_tributaria",
    ),
    "company": (
        "codelco", "enap", "sqm", "cap", "copec", "falabella", "cencosud", "banco de chile", "bci", "santander", "itaú", "bhp", "escondida", "minera escondida", "centinela", "minera centinela",
        "antofagasta minerals", "bancoestado", "banco estado", "banco ripley", "spacex",
    ),
    "commodity": ("cobre", "litio", "petróleo", "minería", "opep", "gas natural", "gas_natural", "gas licuado", "gas_licuado", "gasolina", "gasolinas", "brent", "wti", "petroleo_brent", "petroleo_wti"),
    "political": ("gobierno", "presidente", "ministerio", "ministro", "ley", "proyecto", "congreso", "ejecutivo", "regulación", "reforma", "impuestos", "tributaria", "fiscalización", "sanción"),
    "geopolitical": ("estados unidos", "trump", "china", "irán", "israel", "rusia", "ucrania", "guerra", "conflicto", "estrecho de ormuz", "otan", "onu", "casa blanca"),
    "noise": ("carabineros", "pdi", "fiscalía", "ministerio público", "prisión preventiva", "detención", "delito", "homicidio", "víctima", "policía"),
    "ambiguous": ("acciones", "capital", "mercado", "empresa", "empresas", "bolsa", "bonos"),
    "amount": ("millones", "miles", "pesos", "dólares", "usd", "uf", "$", "mil", "mil millones", "billón", "billones", "us$"),
    "amount_context": (
        "hacienda", "ministerio_de_hacienda", "ministro_de_hacienda", "presupuesto", "deficit_fiscal", "gasto_fiscal", "politica_fiscal", "subsidio_electrico", "recursos_publicos", "banco_central",
        "mercado_financiero", "wall_street", "bolsa", "bonos", "renta_fija", "renta_variable", "ipc", "inflación", "tasa_de_interes", "tipo_de_cambio", "codelco", "enap", "sqm", "cap", "copec",
        "falabella", "cencosud", "ingresos", "utilidades", "ganancias", "pérdidas", "deuda", "financiamiento", "inversión", "cobre", "litio", "petróleo", "gas", "iva", "sii", "deuda_publica",
        "recaudacion_tributaria", "balance_fiscal",
    ),
    "market_context": (
        "bolsa", "wall_street", "renta_variable", "mercado_financiero", "inversionistas", "bursátil", "índice", "acciones chilenas", "acciones_chilenas", "acciones bursátiles", "acciones_bursatiles",
        "dow_jones", "nasdaq", "nasdaq_100", "sp500", "bonos_tesoro_eeuu", "bonos_soberanos", "bonos_corporativos", "reserva_federal", "fed", "mercado_bursatil", "bolsa_santiago", "bolsa_valores",
    ),
    "energy_word": ("energía",),
    "energy_context": (
        "eléctrico", "eléctrica", "tarifa", "tarifas", "tarifario", "subsidio_electrico", "generación eléctrica", "transmisión eléctrica", "distribución eléctrica", "enap", "petróleo", "gas",
        "combustible", "combustibles", "bencina", "diésel", "opep",
    ),
    "gas_word": ("gas",),
    "gas_strong": (
        "rusia", "ucrania", "irán", "israel", "china", "estados_unidos", "donald_trump", "sanciones económicas", "sanciones comerciales", "sanciones financieras", "sanciones internacionales", "opep",
        "estrecho_de_ormuz",
    ),
    "gas_weak": ("guerra", "conflicto"),
    "hard_event": (
        "irán", "israel", "rusia", "ucrania", "guerra", "conflicto", "estrecho_de_ormuz", "aranceles", "ataque", "ataques", "tensión", "tensiones", "bloqueo", "alto al fuego", "misil", "misiles",
        "represalia", "represalias",
    ),
    "direct_context": (
        "petróleo", "opep", "estrecho_de_ormuz", "aranceles", "sanciones económicas", "sanciones comerciales", "sanciones financieras", "sanciones internacionales", "exportaciones", "importaciones",
        "cadena de suministro", "wall_street", "bolsa", "dólar", "tipo_de_cambio",
    ),
    "support_context": ("precios", "comercio", "mercado", "dólares", "millones", "sanciones"),
}
