"""Small federation fixture: 12 customers and 25 orders (database side), 10
products (CSV side). Fixed values: ids, cities, dates, amounts, methods and
statuses are the course fixture's (the golden values depend on them); names,
phones and e-mails are neutral placeholders (two customers have no e-mail)."""

CLIENTS_COLUMNS = "client_id string, nom string, ville string, telephone string, email string, date_inscription date"
CLIENTS = [
    ("C001", "Client 01", "Dakar", "77 000 00 01", "client01@exemple.sn", "2024-09-12"),
    ("C002", "Client 02", "Thies", "77 000 00 02", "client02@exemple.sn", "2024-10-03"),
    ("C003", "Client 03", "Dakar", "77 000 00 03", "client03@exemple.sn", "2024-11-21"),
    ("C004", "Client 04", "Dakar", "77 000 00 04", None, "2025-01-15"),
    ("C005", "Client 05", "Saint-Louis", "77 000 00 05", "client05@exemple.sn", "2025-02-08"),
    ("C006", "Client 06", "Kaolack", "77 000 00 06", "client06@exemple.sn", "2025-03-19"),
    ("C007", "Client 07", "Ziguinchor", "77 000 00 07", "client07@exemple.sn", "2025-04-27"),
    ("C008", "Client 08", "Dakar", "77 000 00 08", "client08@exemple.sn", "2025-05-30"),
    ("C009", "Client 09", "Touba", "77 000 00 09", None, "2025-06-14"),
    ("C010", "Client 10", "Rufisque", "77 000 00 10", "client10@exemple.sn", "2025-07-22"),
    ("C011", "Client 11", "Mbour", "77 000 00 11", "client11@exemple.sn", "2025-08-09"),
    ("C012", "Client 12", "Louga", "77 000 00 12", "client12@exemple.sn", "2025-09-05"),
]

COMMANDES_COLUMNS = ("commande_id string, client_id string, produit_id string, montant_fcfa int, "
                     "moyen_paiement string, statut string, date_commande date")
COMMANDES = [
    ("CMD01", "C001", "P001", 145000, "Orange Money", "livree", "2025-10-02"),
    ("CMD02", "C003", "P002", 25000, "Wave", "livree", "2025-10-05"),
    ("CMD03", "C002", "P010", 8500, "especes", "livree", "2025-10-07"),
    ("CMD04", "C001", "P003", 32000, "Orange Money", "livree", "2025-10-12"),
    ("CMD05", "C008", "P005", 57500, "carte", "livree", "2025-10-15"),
    ("CMD06", "C005", "P007", 12000, "Wave", "en_cours", "2025-10-18"),
    ("CMD07", "C004", "P008", 74500, "Orange Money", "livree", "2025-10-21"),
    ("CMD08", "C010", "P009", 15500, "Wave", "livree", "2025-10-24"),
    ("CMD09", "C006", "P006", 39000, "especes", "annulee", "2025-10-27"),
    ("CMD10", "C003", "P004", 28500, "Orange Money", "livree", "2025-11-01"),
    ("CMD11", "C009", "P010", 8500, "especes", "livree", "2025-11-04"),
    ("CMD12", "C012", "P008", 74500, "carte", "livree", "2025-11-08"),
    ("CMD13", "C001", "P002", 25000, "Wave", "livree", "2025-11-11"),
    ("CMD14", "C008", "P006", 39000, "Orange Money", "en_cours", "2025-11-14"),
    ("CMD15", "C999", "P004", 28500, "Wave", "livree", "2025-11-17"),
    ("CMD16", "C002", "P001", 145000, "Orange Money", "livree", "2025-11-20"),
    ("CMD17", "C005", "P007", 12000, "especes", "annulee", "2025-11-23"),
    ("CMD18", "C004", "P003", 32000, "Wave", "livree", "2025-11-26"),
    ("CMD19", "C010", "P001", 145000, "carte", "livree", "2025-11-29"),
    ("CMD20", "C006", "P010", 8500, "Orange Money", "livree", "2025-12-02"),
    ("CMD21", "C003", "P002", 25000, "Wave", "en_cours", "2025-12-05"),
    ("CMD22", "C009", "P005", 57500, "Orange Money", "livree", "2025-12-08"),
    ("CMD23", "C012", "P007", 12000, "especes", "livree", "2025-12-11"),
    ("CMD24", "C001", "P008", 74500, "carte", "livree", "2025-12-14"),
    ("CMD25", "C008", "P009", 15500, "Wave", "annulee", "2025-12-17"),
]

PRODUITS_CSV = """produit_id,nom_produit,categorie,prix_fcfa,stock
P001,Smartphone Android,Electronique,145000,8
P002,Casque Bluetooth,Electronique,25000,15
P003,Sac en cuir,Mode,32000,6
P004,Robe wax,Mode,28500,12
P005,Montre connectee,Electronique,57500,0
P006,Chaussures sport,Mode,39000,10
P007,Batterie externe,Electronique,12000,20
P008,Boubou brode,Mode,74500,5
P009,Ecouteurs sans fil,Electronique,15500,18
P010,Ceinture cuir,Mode,8500,9
"""
