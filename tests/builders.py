"""Rows that several test modules build."""

DAY = "2024-05-12"


def row(key="X", replaced="", day=DAY, modified=DAY, received=DAY, label="D", place="11069", size="75"):
    return (key, replaced, day, modified, received, label, place, size)


def land(folder, name, text, bom=True):
    folder.mkdir(exist_ok=True)
    (folder / name).write_bytes((b"\xef\xbb\xbf" if bom else b"") + text.encode())


HEADER = (
    "numero_dpe,numero_dpe_remplace,date_etablissement_dpe,date_derniere_modification_dpe,date_reception_dpe,"
    "date_fin_validite_dpe,etiquette_dpe,etiquette_ges,code_insee_ban,nom_commune_ban,code_departement_ban,code_region_ban,"
    "coordonnee_cartographique_x_ban,coordonnee_cartographique_y_ban,score_ban,statut_geocodage,type_batiment,"
    "annee_construction,surface_habitable_logement,conso_5 usages_par_m2_ep,cout_total_5_usages"
)


def certificate(key, replaced="", day="2024-03-10", modified="2024-03-11", label="D", place="05061", dept="05", size="80", use="200"):
    return (
        f"{key},{replaced},{day},{modified},{day},2034-03-10,{label},C,{place},Gap,{dept},01,944000,6388000,0.9,"
        f"adresse géocodée ban à l'adresse,maison,1950.0,{size},{use},1600"
    )
