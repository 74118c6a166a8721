"""What each source sends and how it is typed.

A contract lists the target columns in load order, the header synonyms each may
carry (first match wins), and how the text becomes a value.  Header names are
compared in their technical form (:func:`rosterflow.functions.text.header_name`).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from rosterflow.functions import dates, identity, numbers, periods
from rosterflow.functions.text import limit_text, strip

Convert = Callable[[Column], Column]


@dataclass(frozen=True)
class Field:
    """One target column: its synonyms and its conversion, a derivation from typed columns, or what the file's path tells."""

    name: str
    synonyms: tuple[str, ...] = ()
    convert: Convert | str | None = None
    twin: tuple[str, int] | None = None
    derive: Callable[[], Column] | None = None
    of_file: Callable[[Column], Column] | None = None


@dataclass(frozen=True)
class Contract:
    name: str
    fields: tuple[Field, ...]
    key: str
    # Workbook scan.
    sheets: tuple[str, ...] = ()
    sheet_index: int = 0
    columns: int | None = None
    promoted_header: bool = False
    # Row cleaning.
    drop_leading: bool = False
    drop_trailing: str | None = None  # "canonical" or "raw" columns decide
    money: tuple[str, ...] = ()  # left out of the trailing rule
    total_decimals: Mapping[str, int] = field(default_factory=dict)
    footer: bool = False
    # Key: how the file's name becomes the key.
    canonical: Convert | None = None
    # The key, or a column filled from it, only where the file leaves it wholly empty.
    fill_blank: Mapping[str, Callable[[], Column]] = field(default_factory=dict)
    extra: Mapping[str, Convert] = field(default_factory=dict)  # columns taken from the path
    critical: tuple[str, ...] = ()

    @property
    def load_columns(self) -> list[str]:
        return [f.name for f in self.fields]


# ------------------------------------------------------------------ conversions


def text(size: int) -> Convert:
    return lambda c: limit_text(c, size)


def number(c: Column) -> Column:
    return numbers.to_number(c)


def operation_digits(c: Column) -> Column:
    """The digits of an operation number; what else it holds is left out."""
    return identity.digits_only(c).try_cast("bigint")


def rounded(c: Column) -> Column:
    return numbers.to_whole(c, "round")


def _f(name: str, synonyms: str, convert: Convert | str | None) -> Field:
    return Field(name, tuple(synonyms.split()), convert)


def _from(name: str, derive: Callable[[], Column]) -> Field:
    return Field(name, derive=derive)


WHOLE = "whole"  # strict integer; the load decides what a fraction does


def _name(template: str, **options) -> Convert:
    return lambda path: periods.canonical_name(periods.period_from_name(path, **options), template)


def _period_of_key(name: str = "NOMBRE_ARCHIVO") -> Callable[[], Column]:
    return lambda: periods.plain_period(F.col(name)).cast("bigint")


# --------------------------------------------------------------- fixed values
# Everything below states what the senders use: sheet names, header synonyms in order
# of preference, text sizes, money columns and the configured code tables.

_OPERATION = "n_operacion no_operacion noperacion operacion folio"
_MARSH_MONEY = ("Prima_Bruta_mensual", "IVA", "Prima_Neta", "Diferencia_CCLA")
PRODUCT_POLICIES = {"69": 7391284, "70": 7391285, "71": 7391286}
POLICY_PLANS = {
    "8598974": 4783, "8598978": 8621, "8598975": 8618, "8598976": 8619,
    "8598977": 8620, "8598971": 4784, "8598973": 5677, "8598972": 4780,
}


def _code(table: Mapping[str, int]) -> Convert:
    """Exact-text lookup of a configured table."""

    def convert(c: Column) -> Column:
        mapping = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])
        return F.element_at(mapping, c).cast("bigint")

    return convert


def _broker_head(amount: Convert | str, size: int) -> list[Field]:
    """Columns that the two direct brokers share; one types amounts as whole, the other as decimal."""
    return [
        _f("foliocredito", _OPERATION + " foliocredito", WHOLE),
        _f("rutafiliado", "afirut rut_afiliado rut rutafiliado", WHOLE),
        _f("dvafiliado", "afirutdv dv_afiliado dv dvafiliado", identity.check_digit),
        _f("NombreAfiliado", "afinom nombre_afiliado nombre nombreafiliado", text(size)),
        _f("Plazo", "crecuotot plazo", WHOLE),
        _f("MontoBruto", "cresolmon monto_bruto monto montobruto", amount),
        _f("fecotorgamiento", "fecotorgamiento fecha_otorgamiento fec_otorgamiento", WHOLE),
        _f("fechaPrimerVto", "fecinicob fecha_primer_vto fec_ini_cob fechaprimervto", WHOLE),
        _f("FechaUltimoVto", "fectercob fecha_ultimo_vto fec_ter_cob fechaultimovto", WHOLE),
        _f("ValorCuota", "crecuomon valor_cuota valorcuota", amount),
        _f("FechaPrima", "fechaprima fecha_prima", WHOLE),
        _f("Prima", "prima_cliente prima_bruta prima_cliente_ prima", amount),
        _f("Desgravamen", "prima_desgravamen desgravamen", amount),
        _f("FechaDefuncion", "fecdefuncion fecha_defuncion fechadefuncion", WHOLE),
        _f("OrigenDefuncion", "origen_defuncion origin_defuncion origendefuncion", text(size)),
        _f("Producto", "producto", text(size)),
        _f("FolioOrigen", "folio_original folio_origen folioorigen", WHOLE),
        _f("FechaOrigen", "fecha_otorgamiento_folio_original fecha_origen fechaorigen", WHOLE),
        _f("TasaOrigen", "tasa_interes tasaorigen", number),
    ]


MARSH = Contract(
    name="marsh",
    key="Nombre_de_archivo",
    sheets=("base", "Base cesantia SURA Stock", "Base"),
    fields=(
        *_broker_head(WHOLE, 50),
        _f("Corredora", "corredora", text(50)),
        _f("FECHA_DE_VENTA", "fecha_de_venta fechadeventa fecha_venta", dates.date_number),
        _f("FECHA_DE_BAJA", "fecha_de_baja fechadebaja fecha_baja", dates.date_number),
        _f("Poliza", "poliza póliza", WHOLE),
        _f("Tasa", "tasa_interes tasa", number),
        _f("Prima_Bruta_mensual", "prima_bruta_mensual prima_bruta", number),
        _f("IVA", "iva", number),
        _f("Prima_Neta", "primaneta prima_neta", number),
        _f("Diferencia_CCLA", "diferencia_ccla diferenciaccla", number),
        Field("Nombre_de_archivo", convert=text(50)),
    ),
    drop_trailing="canonical",
    money=_MARSH_MONEY,
    canonical=_name("planes"),
    critical=("foliocredito", "rutafiliado", "dvafiliado", "Nombre_de_archivo"),
)

CONOSUR = Contract(
    name="conosur",
    key="Nombre_de_archivo",
    sheets=("Cesantia_Conosur", "cesantia_conosur", "conosur_cesantia"),
    sheet_index=1,
    fields=(
        *_broker_head(number, 255),
        _f("POLIZA", "poliza póliza", WHOLE),
        _f("TASA", "tasa_interes tasa", number),
        _f("PrimaBrutaMensual", "prima_bruta_mensual prima_bruta", number),
        _f("IVA", "iva", number),
        _f("PrimaNetaMensual", "primaneta prima_neta nan", number),
        Field("Nombre_de_archivo", convert=text(50)),
    ),
    promoted_header=True,
    drop_leading=True,
    drop_trailing="raw",
    canonical=_name("planes"),
    critical=("foliocredito", "rutafiliado", "dvafiliado", "Nombre_de_archivo"),
)


def _intermediated(name: str, variable: str, code: str, sheets: tuple[str, ...], *, plans: bool = False) -> Contract:
    """The four files of the third broker; they differ in the variable commission and the plan columns."""
    plan_fields = (_f("Tasa", "tasa_interes tasa", number), _f("Planes", "plan", text(510))) if plans else ()
    return Contract(
        name=name,
        key="Nombre_de_archivo",
        sheets=sheets,
        fields=(
            _f("foliocredito", _OPERATION, WHOLE),
            _f("NombreAfiliado", "afinom nombre_afiliado nombre", text(510)),
            _f("rutafiliado", "afirut rut_afiliado rut", WHOLE),
            _f("dvafiliado", "afirutdv dv_afiliado dv", identity.check_digit),
            _f("Plazo", "crecuotot plazo", WHOLE),
            _f("MontoBruto", "cresolmon monto_bruto monto", number),
            _f("fechaPrimerVto", "fecinicob fecha_primer_vto fec_ini_cob", WHOLE),
            _f("FechaUltimoVto", "fectercob fecha_ultimo_vto fec_ter_cob", WHOLE),
            _f("ValorCuota", "crecuomon valor_cuota", number),
            _f("PrimaBruta", "prima_cliente prima_bruta prima_cliente_", number),
            *plan_fields,
            _f("PrimaNeta", "prima_exenta prima_neta", number),
            _f("Comision25", "comision_caja_25 comision_caja_25_ comision_25", number),
            _f(variable, f"comision_caja_variable_{code} comision_variable_{code} comision_{code}", number),
            _f("Producto", "producto", text(510)),
            _f("FolioOrigen", "folio_original folio_origen", WHOLE),
            _f("FechaOrigen", "fecha_otorgamiento_folio_original fecha_origen", WHOLE),
            Field("Nombre_de_archivo", convert=text(50)),
        ),
        drop_trailing="canonical",
        money=("PrimaBruta", "PrimaNeta", "Comision25") + (() if plans else (variable,)),
        canonical=_name("planes") if plans else lambda path: periods.canonical_in_place(periods.base_name(path)),
        critical=("foliocredito", "rutafiliado", "dvafiliado", "FolioOrigen", "Nombre_de_archivo"),
    )


FLUJO = _intermediated("flujo", "ComisionVariable", "33", ("Base Flujo", "Base cesantia SURA Flujo", "Base"))
FLUJO2 = _intermediated("flujo2", "ComisionVariable26", "26", ("Base Flujo 2.0", "Base cesantia SURA Flujo 2.0", "Base Flujo 2"))
STOCK = _intermediated("stock", "ComisionVariable", "39", ("Base Stock", "Base cesantia SURA Stock", "Base"))
PLANES = _intermediated("planes", "ComisionVariable", "39", ("Base Planes", "planes", "Planes"), plans=True)

# Money columns and digits of the strict total rule, where a source's files end in a total.
TOTAL_DECIMALS = {
    "flujo": {"PrimaBruta": 0, "PrimaNeta": 2, "Comision25": 2, "ComisionVariable": 2},
    "flujo2": {"PrimaBruta": 0, "PrimaNeta": 2, "Comision25": 2, "ComisionVariable26": 2},
    "stock": {"PrimaBruta": 0, "PrimaNeta": 2, "Comision25": 2, "ComisionVariable": 2},
    "planes": {"PrimaBruta": 0, "PrimaNeta": 2, "Comision25": 2},
    "ripley_fraud": {"uf_bruta": 4, "afecti": 4, "exento_iva": 4, "neto": 4},
}

RIPLEY_FRAUD = Contract(
    name="ripley_fraud",
    key="NOMBRE_ARCHIVO",
    sheets=("Base", "base", "BASE"),
    sheet_index=2,
    fields=(
        _f("FECHA_CARGO", "fecha_cargo fechacargo fec_cargo feccargo", dates.strict_timestamp_number),
        _f("NUM_CUOTA", "num_cuota nro_cuota numerocuota", rounded),
        _f("CUOTA_PRIMA", "cuota_prima cuotaprima prima_bruta_clp primabrutaclp", number),
        _f("PROPUESTA_COM", "propuesta_com propuestacom num_propuesta numpropuesta", WHOLE),
        Field("RUT_DEUDOR", convert=lambda c: rounded(identity.hyphen_number(c)), twin=("rut_cliente", 0)),
        Field("DV_DEUDOR", convert=identity.hyphen_digit, twin=("rut_cliente", 0)),
        _f("SEGURO", "seguro nombre_seguro nombreseguro", text(255)),
        _f("COMPANIA", "compania compania_seguradora companiaseguradora", text(255)),
        _f("PRIMA_UF", "valor_en_uf valorenuf prima_bruta_uf primabrutauf", number),
        Field("RUT_CLIENTE", convert=lambda c: rounded(identity.hyphen_number(c)), twin=("rut_cliente", 1)),
        Field("DV_CLIENTE", convert=identity.hyphen_digit, twin=("rut_cliente", 1)),
        _f("FECHA_VCTO", "fecha_vcto fechavcto fec_vcto fecvcto", rounded),
        _f("OBSERVACION", "observaciones observacion obs", text(255)),
        _f("POLIZA", "poliza nro_poliza numeropoliza", WHOLE),
        Field("NOMBRE_ARCHIVO", convert=text(255)),
        _from("ANO_MES_CARGA", _period_of_key()),
        _from("PRIMA_NETA_UF", lambda: numbers.net_of_vat(F.col("PRIMA_UF"))),
    ),
    total_decimals=TOTAL_DECIMALS["ripley_fraud"],
    canonical=_name("ripley_fraud", extra_words=True),
    critical=("RUT_DEUDOR", "PRIMA_UF", "POLIZA", "NOMBRE_ARCHIVO"),
)

ITAU_FRAUD = Contract(
    name="itau_fraud",
    key="NOMBRE_ARCHIVO",
    sheets=("BBDD", "bbdd", "BASE", "base"),
    sheet_index=3,
    fields=(
        _f("Cliente", "nro_cliente num_cliente", rounded),
        _f("RUT", "rut", identity.joined_number),
        _f("DVRUT", "rut", identity.joined_digit),
        _f("NOMBRE", "nombre nombre_cliente", text(255)),
        _f("FECHACOBRO", "fechacobro fecha_cobro", lambda c: dates.as_int(dates.mixed_date(c))),
        _f("CodigoPago", "mediodepago medio_pago", WHOLE),
        _f("Monto", "monto", rounded),
        _f("KIT", "kit", text(2)),
        _f("Producto", "producto", text(255)),
        _f("Prima_UF", "prima_uf", number),
        _f("Vigencia", "vigencia", lambda c: dates.as_int(dates.text_date(c))),
        _f("PARTNER_BANCO", "compania", text(255)),
        _f("Fecha_Nacimiento", "fecha_nacimiento", lambda c: dates.as_int(dates.mixed_date(c))),
        _f("MediodePago", "medio_de_pago", text(255)),
        _f("xx", "xx", text(255)),
        _f("Posee_IVA", "posee_ap", number),
        _f("Producto_SURA", "producto_sura", text(255)),
        _f("TIPO_SEGURO", "tipo_seguro", text(255)),
        _f("Prima_NETA_UF", "prima_neta_uf", number),
        _f("MES", "mes", rounded),
        _f("AÑO", "ano", rounded),
        _f("MES_AÑO", "mes_ano", text(255)),
        _f("Prima_Neta", "prima_neta", number),
        _f("UF", "uf", number),
        Field("NOMBRE_ARCHIVO", convert=text(255)),
    ),
    canonical=_name("itau_fraud", extra_words=True),
    critical=("RUT", "Prima_UF", "Prima_NETA_UF", "NOMBRE_ARCHIVO"),
)

SERVIHABIT = Contract(
    name="servihabit",
    key="NOMBRE_ARCHIVO",
    sheets=("Cesantia", "cesantia", "Recaudacion_ServiHabit"),
    fields=(
        _f("Guia", "guia", rounded),
        _f("Operacion", "nro_operacion " + _OPERATION + " foliocredito", rounded),
        _f("SVS", "svs s_v_s", rounded),
        _f("Dueno", "dueno dueño nombre_dueno nombre_dueño nombredueno nombredueño", text(100)),
        _f("Rut", "serie_r_u_t rut_afiliado rutafiliado rut rutfiliado", text(24)),
        _f("Cliente", "nombre_cliente nombrecliente cliente nombre_afiliado nombreafiliado", text(100)),
        _f("Plazo", "plazo plazo_meses plazomeses plazo_anios plazoanios plazo_anos plazoanos", rounded),
        _f("Cuota", "cuota cuota_mensual cuotamensual", number),
        _f("Subsidio", "subsidio monto_subsidio montosubsidio", number),
        _f("Cuota_Neta", "cuota_neta cuotaneta cuota_mensual_neta cuotamensualneta", number),
        _f("Prima_Afecta_uf", "prima_afecta_uf prima_afecta", number),
        _f("Iva_Afecta_uf", "iva_afecta_uf iva_prima_afecta", number),
        _f("Total_Prima_uf", "total_prima_uf total_prima", number),
        _f("Afecta_Neta_clp", "afecta_neta_clp afectaneta_clp afecta_neta afectaneta", number),
        _f("Iva_clp", "iva_clp ivaclp iva", number),
        _f("Total_Prima_CLP", "total_prima_clp totalprimaclp total", number),
        _f("Poliza", "poliza póliza n_poliza npoliza", rounded),
        _f("Plan_Tecnico", "plan_tecnico plantecnico plan_tecnicolife plantecnicolife", rounded),
        _f("NOMBRE_ARCHIVO", "nombre_archivo nombrearchivo mes_carga", text(200)),
        _f("MES_RECAUDACION", "mes_recaudacion mesrecaudacion mes_de_recaudacion mesderecaudacion", text(12)),
        _f("rut2", "serie_r_u_t rut_afiliado rutafiliado rut rutfiliado", identity.joined_number),
        _f("dv2", "serie_r_u_t rut_afiliado rutafiliado rut rutfiliado", identity.joined_digit),
    ),
    canonical=_name("servihabit"),
    fill_blank={
        "NOMBRE_ARCHIVO": lambda: F.col("_name"),
        "MES_RECAUDACION": lambda: periods.plain_period(F.col("NOMBRE_ARCHIVO")),
    },
    critical=("Poliza", "Plan_Tecnico", "NOMBRE_ARCHIVO", "MES_RECAUDACION", "rut2"),
)

CONCRECES = Contract(
    name="concreces",
    key="NOMBRE_ARCHIVO",
    sheets=("Base", "base"),
    fields=(
        _f("Guia", "guia", rounded),
        _f("Operacion", "nro_operacion " + _OPERATION + " foliocredito", text(525)),
        _f("Poliza", "poliza póliza n_poliza npoliza", rounded),
        _f("RUT", "serie_r_u_t rut_afiliado rutafiliado rut rutfiliado", rounded),
        _f("DV", "digito_r_u_t dv_afiliado dvafiliado dv dvfiliado", identity.check_digit),
        _f("Fecha_Nacimiento", "fecha_nacimiento fechanacimiento fecha_de_nacimiento fechadenacimiento", dates.text_date),
        _f("Fecha_Escritura", "fecha_escritura fechaescritura fecha_de_escritura fechadeescritura", dates.text_date),
        _f("Plazos_Anuales", "plazo_no_anos plazosanuales plazos_anual plazosanual", rounded),
        _f("Factor", "factor", number),
        _f("FactorMensual", "factor_mensual factormensual", number),
        _f("Prima_UF", "prima_uf primauf", number),
        _f("Prima_Pesos", "prima_pesos primapesos", rounded),
        _f("Fecha_Conversion", "fecha_conversion fechaconversion fecha_de_conversion fechadeconversion", dates.text_date),
        _f("Capital", "capital_asegurado capitalasegurado capital", rounded),
        _f("Credito", "credito_asegurado creditoasegurado credito", rounded),
        _f("Saldo_Insoluto", "saldo_insoluto saldoinsoluto", number),
        _f("Plan_Tecnico", "poliza póliza n_poliza npoliza", _code(POLICY_PLANS)),
        Field("NOMBRE_ARCHIVO", convert=text(255)),
        _from("MES_RECAUDACION", _period_of_key()),
        _f("Operacion2", "nro_operacion " + _OPERATION + " foliocredito", operation_digits),
    ),
    canonical=_name("concreces"),
    critical=("Operacion", "RUT", "Poliza", "NOMBRE_ARCHIVO"),
)


def _sql_date(c: Column) -> Column:
    return dates.clamp_date(dates.text_date(c))


UNIDAD_LEASING = Contract(
    name="unidad_leasing",
    key="NOMBRE_ARCHIVO",
    fields=(
        _f("Guia", "unnamed_0", WHOLE),
        _f("Operacion", "operacion", text(50)),
        _f("Oper_Unidad", "oper_unidad operacion_unidad operacionunidad", text(50)),
        _f("RUT", "rut_deudor rut", WHOLE),
        _f("DV", "dv dv_deudor", identity.check_digit),
        _f("Tipo_Vivienda", "tipo_vivienda vivienda", text(50)),
        _f("Comuna", "comuna", text(50)),
        _f("Poliza", "nro_poliza poliza", WHOLE),
        _f("Prima_Ces", "prima_ces", number),
        _f("Fecha_Ctto", "fecha_ctto", _sql_date),
        _f("Fecha_Vcmto", "fecha_vcmto", _sql_date),
        _f("Fecha_Carga", "fecha_carga fechacarga", _sql_date),
        _f("Fecha_Nac", "fecha_nac fechanac fecha_nacimiento", _sql_date),
        _f("Primer_Vcmto", "primer_vcmto", _sql_date),
        _f("Prima_Bruta_PPI", "seg_ces", number),
        _f("Monto_Asegurado", "tot_cupon_c_seg", number),
        Field("NOMBRE_ARCHIVO", convert=text(50)),
        _f("Operacion2", "operacion", operation_digits),
        _f("Oper_Unidad2", "oper_unidad operacion_unidad operacionunidad", operation_digits),
        _from("MES_RECAUDACION", _period_of_key()),
    ),
    footer=True,
    canonical=_name("unidad_leasing"),
    critical=("Operacion", "RUT", "Poliza", "NOMBRE_ARCHIVO"),
)

COLMENA = Contract(
    name="colmena",
    key="NOMBRE_ARCHIVO",
    sheets=("MaestroCesantiaPlus", "maestrocesantiaplus"),
    fields=(
        _f("Guia", _OPERATION + " foliocredito", rounded),
        _f("RUT", "afirut rut_afiliado rut rutafiliado rut_titular", rounded),
        _f("DV", "afirutdv dv_afiliado dv dvafiliado", identity.check_digit),
        _f("ID_Producto", "id_producto idproducto producto_id productoid", rounded),
        _f("Producto", "producto nombre_producto nombreproducto", text(300)),
        _f("Costo_Total", "costo_total costototal monto_total montototal", number),
        _f("Fecha_Nacimiento", "fecha_nacimiento fechanacimiento fec_nacimiento fecnacimiento", dates.text_date),
        _f("Fecha_Suscripcion", "fecha_suscripcion fechasuscripcion fec_suscripcion fecsuscripcion", dates.text_date),
        _f("Prima_UF", "monto_prima montoprima prima_uf primauf", number),
        _f("Poliza", "id_producto idproducto producto_id productoid", _code(PRODUCT_POLICIES)),
        Field("NOMBRE_ARCHIVO", convert=text(255)),
        _from("MES_RECAUDACION", _period_of_key()),
        _from("Fecha_Nac", lambda: dates.as_int(F.col("Fecha_Nacimiento"))),
        _from("Fecha_Sus", lambda: dates.as_int(F.col("Fecha_Suscripcion"))),
    ),
    canonical=_name("colmena"),
    critical=("RUT", "Poliza", "NOMBRE_ARCHIVO"),
)

BANIGUALDAD = Contract(
    name="banigualdad",
    key="NOMBRE_ARCHIVO",
    fields=(
        _f("PROPUESTA", "numero_propuesta", None),
        _f("FECHA_PAGO", "fecha_de_pago", None),
        _f("RUTAFILIADO", "rut_afiliado", None),
        _f("NOMBREAFILIADO", "nombre_afiliado", None),
        _f("CUOTA", "n_cuota", None),
        _f("VALOR_CUOTA_BRUTO_CLP", "valor_cuota_bruto_pesos", None),
        _f("NOMBRE_ARCHIVO", "nombre_archivo", None),
    ),
    canonical=periods.remittance_name,
    fill_blank={"NOMBRE_ARCHIVO": lambda: F.col("_name")},
)

LOS_HEROES = Contract(
    name="los_heroes",
    key="Mes_Referencia",
    sheet_index=1,
    columns=13,
    fields=(
        _f("Mes_Referencia", "periodo mes_referencia", numbers.truncated_whole),
        _f("Poliza", "poliza", strip),
        _f("Numero_Operacion", "numero_operacion operacion n_operacion num_operacion nro_operacion numero_de_operacion", numbers.truncated_whole),
        _f("RUT", "rut", lambda c: F.regexp_replace(c, r"\D", "")),
        _f("DV_RUT", "dv_rut digito_verificador dv", lambda c: F.upper(strip(c))),
        _f("Tipo_Cliente", "tipo_cliente tipo_de_cliente", strip),
        _f("PRIMA", "prima prima_bruta", numbers.fixed_text),
        _f("tipo_Moneda", "tipo_moneda moneda tipo_de_moneda", strip),
        _f("Nombre_Asegurado", "nombre_asegurado asegurado nombre_cliente cliente", strip),
        _f("Prima_Neta", "prima_neta", numbers.fixed_text),
        _f("Plazo", "plazo", numbers.truncated_whole),
        _f("Tramo", "tramo", strip),
        _f("Mes_venta", "mes_venta fecha_venta", lambda c: F.date_format(dates.listed_date(c), "yyyy-MM-dd")),
        _f("Monto_Credito", "monto_credito", numbers.fixed_text),
        _f("Monto_Cuota", "monto_cuota", numbers.fixed_text),
    ),
    extra={
        "poliza": periods.policy_from_name,
        "periodo": lambda path: F.coalesce(
            periods.plain_period(F.regexp_extract(path, r"([^/\\]*)[/\\][^/\\]*$", 1)),
            periods.plain_period(periods.base_name(path)),
        ),
    },
)

RIPLEY_LIFE = Contract(
    name="ripley_life",
    key="NOMBRE_ARCHIVO",
    sheets=("Recaudacion", "Recaudación", "recaudacion"),
    sheet_index=1,
    fields=(
        _f("NUM_CUOTA", "num_cuota nro_cuota", strip),
        _f("PRIMA_BRUTA_CLP", "cuota_prima cuotaprima", strip),
        _f("PROPUESTA_COM", "propuesta_com", strip),
        _f("PRIMA_BRUTA_UF", "prima_bruta_uf", strip),
        _f("SEGURO", "seguro", strip),
        _f("COMPANIA", "compania", strip),
        _f("RUT CLIENTE", "rut_cliente", None),
        _f("RUT", "rut_cliente", identity.joined_number),
        _f("DV_RUT", "rut_cliente", identity.joined_digit),
        _f("FECHA_CARGO", "fecha_cargo", dates.text_date),
        _f("FECHA VCTO", "fecha_vcto", lambda c: dates.as_int(dates.text_date(c)).cast("double")),
        _f("VIDA", "vida", strip),
        _f("GENERALES", "generales", strip),
        Field("NUMERO_ARCHIVO", of_file=periods.period_from_name),
        Field("NOMBRE_ARCHIVO", convert=text(255)),
    ),
    canonical=periods.base_name,
    critical=("RUT", "NOMBRE_ARCHIVO"),
)

CONTRACTS = {
    c.name: c
    for c in (
        MARSH, CONOSUR, FLUJO, FLUJO2, STOCK, PLANES, RIPLEY_FRAUD, ITAU_FRAUD, SERVIHABIT,
        CONCRECES, UNIDAD_LEASING, COLMENA, BANIGUALDAD, LOS_HEROES, RIPLEY_LIFE,
    )
}
