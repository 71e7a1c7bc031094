"""The built-in reference table of parent areas (department, region, mainland or not)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SCHEMA = "code_departement string, nom_departement string, nom_region string, est_metropole boolean"

# Code, name and region of each area, and whether it lies on the mainland, in code order.
AREAS = [
    ("01", "Ain", "Auvergne-Rhône-Alpes", True),
    ("02", "Aisne", "Hauts-de-France", True),
    ("03", "Allier", "Auvergne-Rhône-Alpes", True),
    ("04", "Alpes-de-Haute-Provence", "Provence-Alpes-Côte d'Azur", True),
    ("05", "Hautes-Alpes", "Provence-Alpes-Côte d'Azur", True),
    ("06", "Alpes-Maritimes", "Provence-Alpes-Côte d'Azur", True),
    ("07", "Ardèche", "Auvergne-Rhône-Alpes", True),
    ("08", "Ardennes", "Grand Est", True),
    ("09", "Ariège", "Occitanie", True),
    ("10", "Aube", "Grand Est", True),
    ("11", "Aude", "Occitanie", True),
    ("12", "Aveyron", "Occitanie", True),
    ("13", "Bouches-du-Rhône", "Provence-Alpes-Côte d'Azur", True),
    ("14", "Calvados", "Normandie", True),
    ("15", "Cantal", "Auvergne-Rhône-Alpes", True),
    ("16", "Charente", "Nouvelle-Aquitaine", True),
    ("17", "Charente-Maritime", "Nouvelle-Aquitaine", True),
    ("18", "Cher", "Centre-Val de Loire", True),
    ("19", "Corrèze", "Nouvelle-Aquitaine", True),
    ("21", "Côte-d'Or", "Bourgogne-Franche-Comté", True),
    ("22", "Côtes-d'Armor", "Bretagne", True),
    ("23", "Creuse", "Nouvelle-Aquitaine", True),
    ("24", "Dordogne", "Nouvelle-Aquitaine", True),
    ("25", "Doubs", "Bourgogne-Franche-Comté", True),
    ("26", "Drôme", "Auvergne-Rhône-Alpes", True),
    ("27", "Eure", "Normandie", True),
    ("28", "Eure-et-Loir", "Centre-Val de Loire", True),
    ("29", "Finistère", "Bretagne", True),
    ("2A", "Corse-du-Sud", "Corse", True),
    ("2B", "Haute-Corse", "Corse", True),
    ("30", "Gard", "Occitanie", True),
    ("31", "Haute-Garonne", "Occitanie", True),
    ("32", "Gers", "Occitanie", True),
    ("33", "Gironde", "Nouvelle-Aquitaine", True),
    ("34", "Hérault", "Occitanie", True),
    ("35", "Ille-et-Vilaine", "Bretagne", True),
    ("36", "Indre", "Centre-Val de Loire", True),
    ("37", "Indre-et-Loire", "Centre-Val de Loire", True),
    ("38", "Isère", "Auvergne-Rhône-Alpes", True),
    ("39", "Jura", "Bourgogne-Franche-Comté", True),
    ("40", "Landes", "Nouvelle-Aquitaine", True),
    ("41", "Loir-et-Cher", "Centre-Val de Loire", True),
    ("42", "Loire", "Auvergne-Rhône-Alpes", True),
    ("43", "Haute-Loire", "Auvergne-Rhône-Alpes", True),
    ("44", "Loire-Atlantique", "Pays de la Loire", True),
    ("45", "Loiret", "Centre-Val de Loire", True),
    ("46", "Lot", "Occitanie", True),
    ("47", "Lot-et-Garonne", "Nouvelle-Aquitaine", True),
    ("48", "Lozère", "Occitanie", True),
    ("49", "Maine-et-Loire", "Pays de la Loire", True),
    ("50", "Manche", "Normandie", True),
    ("51", "Marne", "Grand Est", True),
    ("52", "Haute-Marne", "Grand Est", True),
    ("53", "Mayenne", "Pays de la Loire", True),
    ("54", "Meurthe-et-Moselle", "Grand Est", True),
    ("55", "Meuse", "Grand Est", True),
    ("56", "Morbihan", "Bretagne", True),
    ("57", "Moselle", "Grand Est", True),
    ("58", "Nièvre", "Bourgogne-Franche-Comté", True),
    ("59", "Nord", "Hauts-de-France", True),
    ("60", "Oise", "Hauts-de-France", True),
    ("61", "Orne", "Normandie", True),
    ("62", "Pas-de-Calais", "Hauts-de-France", True),
    ("63", "Puy-de-Dôme", "Auvergne-Rhône-Alpes", True),
    ("64", "Pyrénées-Atlantiques", "Nouvelle-Aquitaine", True),
    ("65", "Hautes-Pyrénées", "Occitanie", True),
    ("66", "Pyrénées-Orientales", "Occitanie", True),
    ("67", "Bas-Rhin", "Grand Est", True),
    ("68", "Haut-Rhin", "Grand Est", True),
    ("69", "Rhône", "Auvergne-Rhône-Alpes", True),
    ("70", "Haute-Saône", "Bourgogne-Franche-Comté", True),
    ("71", "Saône-et-Loire", "Bourgogne-Franche-Comté", True),
    ("72", "Sarthe", "Pays de la Loire", True),
    ("73", "Savoie", "Auvergne-Rhône-Alpes", True),
    ("74", "Haute-Savoie", "Auvergne-Rhône-Alpes", True),
    ("75", "Paris", "Île-de-France", True),
    ("76", "Seine-Maritime", "Normandie", True),
    ("77", "Seine-et-Marne", "Île-de-France", True),
    ("78", "Yvelines", "Île-de-France", True),
    ("79", "Deux-Sèvres", "Nouvelle-Aquitaine", True),
    ("80", "Somme", "Hauts-de-France", True),
    ("81", "Tarn", "Occitanie", True),
    ("82", "Tarn-et-Garonne", "Occitanie", True),
    ("83", "Var", "Provence-Alpes-Côte d'Azur", True),
    ("84", "Vaucluse", "Provence-Alpes-Côte d'Azur", True),
    ("85", "Vendée", "Pays de la Loire", True),
    ("86", "Vienne", "Nouvelle-Aquitaine", True),
    ("87", "Haute-Vienne", "Nouvelle-Aquitaine", True),
    ("88", "Vosges", "Grand Est", True),
    ("89", "Yonne", "Bourgogne-Franche-Comté", True),
    ("90", "Territoire de Belfort", "Bourgogne-Franche-Comté", True),
    ("91", "Essonne", "Île-de-France", True),
    ("92", "Hauts-de-Seine", "Île-de-France", True),
    ("93", "Seine-Saint-Denis", "Île-de-France", True),
    ("94", "Val-de-Marne", "Île-de-France", True),
    ("95", "Val-d'Oise", "Île-de-France", True),
    ("971", "Guadeloupe", "Guadeloupe", False),
    ("972", "Martinique", "Martinique", False),
    ("973", "Guyane", "Guyane", False),
    ("974", "La Réunion", "La Réunion", False),
    ("975", "Saint-Pierre-et-Miquelon", "Collectivités d'outre-mer", False),
    ("976", "Mayotte", "Mayotte", False),
    ("977", "Saint-Barthélemy", "Collectivités d'outre-mer", False),
    ("978", "Saint-Martin", "Collectivités d'outre-mer", False),
    ("984", "Terres australes et antarctiques", "Collectivités d'outre-mer", False),
    ("986", "Wallis-et-Futuna", "Collectivités d'outre-mer", False),
    ("987", "Polynésie française", "Collectivités d'outre-mer", False),
    ("988", "Nouvelle-Calédonie", "Collectivités d'outre-mer", False),
]


def builtin_reference(spark: SparkSession) -> DataFrame:
    """The table above; use ``sources.tables.read_reference`` for one of your own."""
    return spark.createDataFrame(AREAS, SCHEMA)
