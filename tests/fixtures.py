"""Generated purchase-ledger fixtures (no file of the reference is read).

``write_fixtures(folder)`` writes four input files that reproduce the
reference sample's golden counts: 55 purchase rows (53 distinct) → 25
accepted and 30 rejected (22 ``invalid CNPJ``, 4 ``null column(s)``, 2
``null column(s), invalid CNPJ``, 2 ``duplicated``); the accepted rows give
23 suppliers, 23 addresses, 25 invoices and 52 installments.
"""

from __future__ import annotations

from pathlib import Path

W1 = (5, 4, 3, 2, 9, 8, 7, 6, 5, 4, 3, 2)
W2 = (6, 5, 4, 3, 2, 9, 8, 7, 6, 5, 4, 3, 2)


def _dv(digits: str, weights) -> str:
    r = sum(int(d) * w for d, w in zip(digits, weights)) % 11
    return str(0 if r < 2 else 11 - r)


def make_cnpj(base12: str) -> str:
    d1 = _dv(base12, W1)
    return base12 + d1 + _dv(base12 + d1, W2)


def break_cnpj(valid: str) -> str:
    return valid[:-1] + str((int(valid[-1]) + 1) % 10)


COLUMNS = [
    "NOME_FORNECEDOR", "CNPJ_FORNECEDOR", "EMAIL_FORNECEDOR", "TELEFONE_FORNECEDOR", "NUMERO_NF", "DATA_EMISSAO",
    "VALOR_NET", "VALOR_TRIBUTO", "VALOR_TOTAL", "NOME_ITEM", "QTD_ITEM", "CONDICAO_PAGAMENTO", "CEP", "NUM_ENDERECO",
    "COMPLEMENTO", "TIPO_ENDERECO", "DATA_PROCESSAMENTO",
]

# The payment terms table (with a byte-order mark) and the
# address types table of the ledger.
TERMS_CSV = (
    "﻿ID_CONDICAO,DESCRICAO,QTD_PARCELAS,ENTRADA\r\n"
    "1,A vista,1,1\r\n2,30 dias,1,0\r\n3,30/60 dias,2,0\r\n4,30/60/90 dias,3,0\r\n"
    "5,Entrada/30 dias,2,1\r\n6,Entrada/30/60 dias,3,1\r\n7,Entrada/30/60/90 dias,4,1"
)
ADDRESS_TYPES_CSV = (
    "id_tipo_endereco,nome_tipo_endereco,sigla_endereco\r\n"
    "1,cobranca,COB\r\n2,entrega,ENT\r\n3,faturamento,FAT\r\n4,cobranca/entrega,COB/ENT\r\n"
    "5,cobranca/faturamento,COB/FAT\r\n6,entrega/faturamento,ENT/FAT\r\n7,cobranca/entrega/faturamento,COB/ENT/FAT\r\n"
    "8,fornecedor,FOR"
)

POSTAL_CODES = [12605000 + 10 * i for i in range(30)]

# raw spellings of the 25 accepted invoices' terms (case and spaces vary)
ACCEPTED_TERMS = (
    ["Entrada/30/60/90 dias"] * 7 + ["  ENTRADA/30/60/90 DIAS "]
    + ["Entrada/30 dias"] * 5 + ["entrada/30 dias"]
    + ["A vista"] * 4 + ["30 dias"] * 3 + ["30/60 dias"] * 3 + ["Entrada/30/60 dias"]
)
TERM_COUNTS = {"30/60/90 DIAS": 3, "ENTRADA/30 DIAS": 2, "A VISTA": 1, "30 DIAS": 1, "30/60 DIAS": 2, "ENTRADA/30/60 DIAS": 3}


def supplier(i: int, leading_zero: bool = False) -> dict:
    base = f"0{(1234567 + i * 7919) % 10**7:07d}0001" if leading_zero else f"{10000000 + i * 7919:08d}0001"
    return {
        "NOME_FORNECEDOR": f"Supplier {i:02d} Ltda",
        "CNPJ_FORNECEDOR": make_cnpj(base),
        "EMAIL_FORNECEDOR": f"contact{i}@supplier{i}.example",
        "TELEFONE_FORNECEDOR": f"{100 + i}-555-{1000 + i}",
        "CEP": str(POSTAL_CODES[i % len(POSTAL_CODES)]),
        "NUM_ENDERECO": str(10 + i),
        "COMPLEMENTO": None if i % 4 == 0 else f"LOTE {i:02d}",
        "TIPO_ENDERECO": "fornecedor",
    }


def invoice(sup: dict, nf: int, term: str | None, total: str = "73000") -> dict:
    row = dict(sup)
    row.update({
        "NUMERO_NF": str(nf), "DATA_EMISSAO": "2023-07-01", "VALOR_NET": "70000", "VALOR_TRIBUTO": "3000",
        "VALOR_TOTAL": total, "NOME_ITEM": "Item", "QTD_ITEM": "1", "CONDICAO_PAGAMENTO": term,
        "DATA_PROCESSAMENTO": "2023-11-13",
    })
    return row


def purchase_rows() -> list[dict]:
    rows: list[dict] = []
    terms = iter(ACCEPTED_TERMS)
    nf = 9000000
    # 23 clean suppliers, 25 invoices; suppliers 1 and 2 have two invoices,
    # and one invoice of each is delivered twice (exact duplicate rows)
    for i in range(1, 24):
        sup = supplier(i)
        count = 2 if i in (1, 2) else 1
        for k in range(count):
            nf += 1
            row = invoice(sup, nf, next(terms))
            rows.append(row)
            if (i, k) in ((1, 0), (2, 1)):
                rows.append(dict(row))
    # 28 rows rejected by blocking rules
    bad: list[dict] = []

    def add(i, **changes):
        nonlocal nf
        nf += 1
        row = invoice(supplier(i), nf, "30 dias")
        row.update(changes)
        bad.append(row)

    add(24, CONDICAO_PAGAMENTO=None)                                     # missing term
    add(25, NOME_FORNECEDOR=None)                                        # missing supplier name
    add(26, EMAIL_FORNECEDOR=None, DATA_EMISSAO=None)                    # missing e-mail and date
    add(27, NOME_ITEM=None, CONDICAO_PAGAMENTO=None)                     # missing item and term
    add(28, TELEFONE_FORNECEDOR=None, CNPJ_FORNECEDOR=break_cnpj(supplier(28)["CNPJ_FORNECEDOR"]))
    add(29, VALOR_TOTAL=None, CNPJ_FORNECEDOR=break_cnpj(supplier(29)["CNPJ_FORNECEDOR"]))
    add(30, CNPJ_FORNECEDOR="00" + supplier(30)["CNPJ_FORNECEDOR"])     # 16 digits
    add(31, CNPJ_FORNECEDOR=supplier(31)["CNPJ_FORNECEDOR"][:12])       # 12 digits
    add(32, CNPJ_FORNECEDOR=supplier(32, leading_zero=True)["CNPJ_FORNECEDOR"][1:])  # lost its leading zero
    add(33, COMPLEMENTO=None, CNPJ_FORNECEDOR=break_cnpj(supplier(33)["CNPJ_FORNECEDOR"]))
    for i in range(34, 52):
        add(i, CNPJ_FORNECEDOR=break_cnpj(supplier(i)["CNPJ_FORNECEDOR"]))
    # interleave so duplicates are not adjacent to each other
    out = []
    for k in range(max(len(rows), len(bad))):
        if k < len(bad):
            out.append(bad[k])
        if k < len(rows):
            out.append(rows[k])
    return out


def to_csv(rows: list[dict], columns=COLUMNS, sep: str = ",", header: bool = True, newline: str = "\r\n") -> str:
    lines = [sep.join(columns)] if header else []
    for r in rows:
        lines.append(sep.join("" if r.get(c) is None else r[c] for c in columns))
    return newline.join(lines)  # no newline at the end


def postal_codes_csv(extra: list[str] = ()) -> str:
    lines = [f"{c}; sp ;sao jose dos campos ; bairro {k} ;rua {k}" for k, c in enumerate(POSTAL_CODES)]
    return "\n".join([*lines, *extra]) + "\n"


def write_fixtures(folder: Path, purchases: list[dict] | None = None) -> Path:
    folder.mkdir(parents=True, exist_ok=True)
    (folder / "compras.csv").write_text(to_csv(purchases if purchases is not None else purchase_rows()), encoding="utf-8")
    (folder / "condicao_pagamento.csv").write_text(TERMS_CSV, encoding="utf-8")
    (folder / "tipo_endereco.csv").write_text(ADDRESS_TYPES_CSV, encoding="utf-8")
    (folder / "postal_codes.csv").write_text(postal_codes_csv(), encoding="utf-8")
    return folder
