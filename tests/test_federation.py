"""Federation: two JDBC tables (in-memory Derby, no server) and one CSV file,
checked against the golden values of the course fixture."""

import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from baobab.operators import joins as J
from baobab.operators import kpi
from baobab.sources import files, jdbc
from federation_data import CLIENTS, CLIENTS_COLUMNS, COMMANDES, COMMANDES_COLUMNS, PRODUITS_CSV

DRIVER = "org.apache.derby.jdbc.EmbeddedDriver"
PRODUITS_SCHEMA = StructType([
    StructField("produit_id", StringType(), False), StructField("nom_produit", StringType(), False),
    StructField("categorie", StringType(), False), StructField("prix_fcfa", IntegerType(), False),
    StructField("stock", IntegerType(), False)])


@pytest.fixture(scope="module")
def fed(spark, tmp_path_factory):
    url = f"jdbc:derby:memory:fed{uuid.uuid4().hex[:8]};create=true"
    clients = spark.createDataFrame(CLIENTS, CLIENTS_COLUMNS.replace("date_inscription date", "date_inscription string")) \
        .withColumn("date_inscription", F.to_date("date_inscription"))
    commandes = spark.createDataFrame(COMMANDES, COMMANDES_COLUMNS.replace("date_commande date", "date_commande string")) \
        .withColumn("date_commande", F.to_date("date_commande"))
    jdbc.write_table(clients, url, "clients", driver=DRIVER, num_partitions=1, column_types=(
        "client_id VARCHAR(4), nom VARCHAR(50), ville VARCHAR(30), telephone VARCHAR(20)"))
    jdbc.write_table(commandes, url, "commandes", driver=DRIVER, num_partitions=1, column_types=(
        "commande_id VARCHAR(5), client_id VARCHAR(4), produit_id VARCHAR(4), moyen_paiement VARCHAR(20), "
        "statut VARCHAR(15)"))
    path = tmp_path_factory.mktemp("csv") / "produits.csv"
    path.write_text(PRODUITS_CSV, encoding="utf-8")
    return {
        "url": url,
        "written": (clients, commandes),
        "clients": jdbc.read_table(spark, url, "clients", driver=DRIVER),
        "commandes": jdbc.read_table(spark, url, "commandes", driver=DRIVER),
        "produits": files.read_csv(spark, str(path), PRODUITS_SCHEMA),
        "csv_path": str(path),
    }


def test_roundtrip_counts(fed):
    assert fed["clients"].count() == 12 and fed["commandes"].count() == 25
    for written, name in zip(fed["written"], ["clients", "commandes"]):
        r = jdbc.verify_roundtrip(written, fed[name]).collect()[0]
        assert (r.written, r.read_back, r.missing, r.extra) == (r.written, r.written, 0, 0)


def test_clients_per_city(fed):
    got = {r.ville: r.n for r in kpi.count_by(fed["clients"], "ville").collect()}
    assert len(got) == 9 and got["Dakar"] == 4


def test_status_counts(fed):
    got = {r.statut: (r.nb_commandes, r.ca_fcfa)
           for r in kpi.revenue_by(fed["commandes"], ["statut"]).collect()}
    assert got == {"livree": (19, 997_500), "en_cours": (3, 76_000), "annulee": (3, 66_500)}


def test_inner_join_and_city_revenue(fed):
    j = J.enrich(fed["commandes"], fed["clients"], "client_id", ["ville"])
    assert j.count() == 24
    by_city = kpi.revenue_by(j.where(F.col("statut") == "livree"), ["ville"])
    rows = {r.ville: (r.nb_commandes, r.ca_fcfa) for r in by_city.collect()}
    assert sum(v[1] for v in rows.values()) == 969_000
    assert rows["Dakar"] == (9, 494_000)


def test_orphans_and_clients_without_orders(fed):
    orphans = J.anti(fed["commandes"], fed["clients"], "client_id").collect()
    assert [(r.commande_id, r.client_id, r.montant_fcfa) for r in orphans] == [("CMD15", "C999", 28_500)]
    lonely = J.anti(fed["clients"], fed["commandes"], "client_id").orderBy("client_id").collect()
    assert [r.client_id for r in lonely] == ["C007", "C011"]
    by_outer = J.anti_by_outer(fed["clients"], fed["commandes"], "client_id")
    assert sorted(r.client_id for r in by_outer.collect()) == ["C007", "C011"]


def test_partition_and_audit(fed):
    p = J.partition_check(fed["commandes"], fed["clients"], "client_id").collect()[0]
    assert (p.nb_gauche, p.nb_semi, p.nb_anti, p.partition_ok) == (25, 24, 1, True)
    a = J.join_audit(fed["commandes"], fed["clients"], "client_id", "montant_fcfa").collect()[0]
    assert (a.nb_avant, a.nb_apres, a.nb_perdues, a.nb_dupliquees) == (25, 24, 1, 0)
    assert (a.somme_perdue, a.somme_dupliquee) == (28_500, 0)


def test_not_in_semantics(spark, fed):
    c = fed["commandes"]
    assert J.not_in(c, fed["clients"], "client_id").count() == 1
    with_null = fed["clients"].select("client_id").union(spark.createDataFrame([(None,)], "client_id string"))
    assert J.not_in(c, with_null, "client_id").count() == 0        # one NULL on the right
    empty = fed["clients"].select("client_id").where(F.lit(False))
    assert J.not_in(c, empty, "client_id").count() == 25           # empty right keeps all


def test_category_revenue_three_sources(fed):
    d = fed["commandes"].where(F.col("statut") == "livree")
    j = d.join(fed["produits"], "produit_id")
    got = {r.categorie: (r.nb_commandes, r.ca_fcfa) for r in kpi.revenue_by(j, ["categorie"]).collect()}
    assert got == {"Electronique": (9, 627_500), "Mode": (10, 370_000)}
    share = kpi.conditional_share_by(j, "categorie", F.col("moyen_paiement").isin("Orange Money", "Wave"),
                                     "montant_fcfa", "part_mobile_money")
    assert {r.categorie: r.part_mobile_money for r in share.collect()} == {"Electronique": 65.8, "Mode": 55.1}


def test_cancellation_and_basket(fed):
    rate = kpi.cancellation_rate(fed["commandes"], "moyen_paiement", cancelled="annulee")
    assert {r.moyen_paiement: r.taux_annulation_pct for r in rate.collect()} == {
        "especes": 40.0, "Wave": 12.5, "carte": 0.0, "Orange Money": 0.0}
    basket = kpi.basket_by(fed["commandes"], "moyen_paiement")
    assert {r.moyen_paiement: r.panier_moyen_fcfa for r in basket.collect()} == {
        "carte": 87_875.0, "Orange Money": 66_250.0, "Wave": 22_313.0, "especes": 16_000.0}


def test_top5_orders_tiebreak(fed):
    top = (fed["commandes"].orderBy(F.col("montant_fcfa").desc(), "commande_id").limit(5)
           .select("commande_id").collect())
    assert [r.commande_id for r in top] == ["CMD01", "CMD16", "CMD19", "CMD07", "CMD12"]


def test_pushed_query_and_filter_pushdown(spark, fed):
    q = jdbc.read_query(spark, fed["url"],
                        "SELECT \"client_id\", \"montant_fcfa\" FROM commandes WHERE \"statut\" = 'livree'",
                        driver=DRIVER)
    assert q.count() == 19
    plan = fed["commandes"].where(F.col("statut") == "livree")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "livree" in plan


def test_write_back_overwrite_and_verify(spark, fed):
    j = J.enrich(fed["commandes"].where(F.col("statut") == "livree"), fed["clients"], "client_id", ["ville"])
    report = kpi.revenue_by(j, ["ville"])
    for _ in range(2):  # overwrite twice: the table is replaced, not appended to
        jdbc.write_table(report, fed["url"], "ca_par_ville", driver=DRIVER, num_partitions=1,
                         column_types="ville VARCHAR(30)")
    back = jdbc.read_table(spark, fed["url"], "ca_par_ville", driver=DRIVER)
    r = jdbc.verify_roundtrip(report, back).collect()[0]
    assert (r.missing, r.extra, r.read_back) == (0, 0, 6)


def test_partitioned_jdbc_read(spark, fed):
    c = jdbc.read_table(spark, fed["url"], "commandes", driver=DRIVER, partition_column="montant_fcfa",
                        lower_bound=0, upper_bound=150_000, num_partitions=4)
    assert c.rdd.getNumPartitions() == 4 and c.count() == 25


def test_csv_header_mismatch_is_refused(spark, tmp_path):
    p = tmp_path / "bad.csv"
    p.write_text("produit_id,nom_produit,extra,categorie,prix_fcfa,stock\nP1,a,b,c,1,2\n")
    with pytest.raises(files.SchemaMismatch):
        files.read_csv(spark, str(p), PRODUITS_SCHEMA)
