"""A small raw folder in the real formats: two sales exports with different header
orders, a cp1252 customer file, workbooks for catalogue and budget, a manifest."""

import json
import os

import workbooks
from starproof import specs

# The raw headers as the exports spell them.
HEADERS = ["Date Commande", "N° Commande", "N° Ligne", "Code Client", "Code Produit", "Quantité ", "PU Vente HT ", "Remise %", "Code Commercial", "Statut"]
MONTHS = specs.BUDGET_LAYOUT.month_labels
JANUARY = [
    ["05/01/2024", "O1", "1", "C1", "P1", "2", "1 000,50", "10.0", "S1", "Livrée"],
    ["05/01/2024", "O1", "1", "C1", "P1", "2", "1 000,50", "10.0", "S1", "Livrée"],
    ["05/01/2024", "O1", "2", "C1", "P2", "1", "N/A", "0.0", "S1", "Livrée"],
    ["09/01/2024", "O2", "1", "C2", "P2", "4", "2,5", "0.0", "S1", "Annulée"],
]
FEBRUARY = [
    ["10/02/2024", "O3", "1", "C2", "P2", "3", "20,00", "0.0", "S1", "Livrée"],
    ["32/13/2024", "O4", "1", "C2", "P1", "1", "5,00", "0.0", "S1", "Livrée"],
]
REVENUE = 2 * 1000.50 * 0.9 + 3 * 20.0
EXPECTED = dict(
    ca_reconcilie_attendu_eur=REVENUE, nb_lignes_apres_dedup=5, nb_dates_invalides_attendu=1,
    nb_montants_invalides_attendu=1, nb_categories_apres_normalisation=2,
)


def _csv(path, header, rows, encoding="utf-8"):
    with open(path, "w", encoding=encoding, newline="") as f:
        for row in [header, *rows]:
            f.write(";".join(row) + "\n")


def budget_rows(title, scale):
    header = ["Région", "=Catégorie", *MONTHS]
    rows = [[title], [], header]
    for region in ("Île-de-France", "Nord", "Est", "Sud", "Ouest"):
        for i, category in enumerate(("Consommables", "Mobilier")):
            rows.append([region if i == 0 else None, category, *[scale * (m + 1) for m in range(12)]])
        rows.append([None, "Sous-total", *[2 * scale * (m + 1) for m in range(12)]])
    return rows


def write(folder, manifest=True, xlsx_sales=False, **expected):
    os.makedirs(folder, exist_ok=True)
    at = lambda name: os.path.join(folder, name)
    if xlsx_sales:
        workbooks.write(at("export_ventes_2024-01.xlsx"), {"Feuil1": [HEADERS, *JANUARY]})
        flip = [r[::-1] for r in FEBRUARY]
        workbooks.write(at("export_ventes_2024-02.xlsx"), {"Ventes": [HEADERS[::-1], *flip], "Autre": [["x"]]})
    else:
        _csv(at("export_ventes_2024-01.csv"), HEADERS, JANUARY)
        _csv(at("export_ventes_2024-02.csv"), HEADERS[::-1], [r[::-1] for r in FEBRUARY], "utf-8-sig")
    _csv(
        at("export_clients_crm.csv"),
        ["code_client", "raison_sociale", "segment", "type_etablissement", "code_region", "ville", "code_commercial", "date_premiere_commande"],
        [["C1", "Hôtel de l’Étoile €", "pme", "Hôtel", "R01", "Paris", "S1", "01/02/2019"],
         ["C2", "Café Œuvre", "INDÉPENDANTS ", "Bar", "R04", "Nîmes", "S1", "00/00/0000"]],
        "cp1252",
    )
    _csv(at("commerciaux.csv"), ["code_commercial", "nom", "code_region", "date_embauche"], [["S1", "Zoé", "R01", "2020-03-01"]])
    workbooks.write(at("catalogue_produits.xlsx"), {"Catalogue": [
        ["code_produit", "libelle", "categorie", "sous_categorie", "cout_unitaire", "prix_catalogue", "fournisseur"],
        ["P1", "Gobelet", "Conso.", "x", "500,25", 1200.5, "F1"], ["P2", "Chaise", "=Mobilier", "y", 10, "25,00", None],
    ]})
    workbooks.write(at("budget_2024.xlsx"), {"CA": budget_rows("Budget 2024 CA", 100), "Marge": budget_rows("Budget 2024 Marge", 40)})
    if manifest:
        with open(at("_manifest_anomalies.json"), "w", encoding="utf-8") as f:
            json.dump({"generation": {"seed": 1}, "attendus_apres_nettoyage": {**EXPECTED, **expected}}, f, indent=2)
    return str(folder)
