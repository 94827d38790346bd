import pytest

from ledgerlift.plans import segmentation as seg

SCHEMA = (
    "id_cliente string, nome_cliente string, pais_cliente string, currency string, total_receita_brl double, "
    "ticket_medio_brl double, quantidade_transacoes long, desvio_padrao_brl double, percentual_atraso double, "
    "percentual_pago double, dias_ativos int"
)
FAST = seg.Settings(restarts=3)


def summary(spark, n):
    data = [
        (str(i), f"n{i}", "BRASIL", "BRL", 100.0 * (1 + 9 * (i % 2)) + i, 10.0 + 90 * (i % 2), 5 + i % 2, None, 1.0, 50.0, i)
        for i in range(n)
    ]
    return spark.createDataFrame(data, SCHEMA)


def test_features(spark):
    got = seg.prepare_features(summary(spark, 2)).first()
    assert got.desvio_padrao_brl == 0.0 and got.quantidade_transacoes == 5.0
    with pytest.raises(ValueError):
        seg.prepare_features(spark.createDataFrame([("1",)], "id_cliente string"))


def test_small_inputs(spark):
    assert seg.run_segmentation(summary(spark, 0)) is None
    two = seg.run_segmentation(summary(spark, 2), FAST)
    assert two.metrics["k_escolhido"] == 1 and {r.cluster for r in two.segments.collect()} == {0}
    three = seg.run_segmentation(summary(spark, 3), FAST)
    assert three.metrics["k_escolhido"] == 2 and three.segments.count() == 3


def test_two_groups_are_found(spark):
    result = seg.run_segmentation(summary(spark, 24), seg.Settings(restarts=2, max_k=3))
    assert result.metrics["k_escolhido"] == 2
    labels = {(int(r.id_cliente) % 2, r.cluster) for r in result.segments.collect()}
    assert labels == {(1, 0), (0, 1)}  # the richer group is 0
    assert [k for k, _, _ in result.analysis] == [2, 3]
    assert result.analysis[1][2] <= result.analysis[0][2]
    assert {r.metrica for r in result.metrics_table(spark).collect()} == set(result.metrics)


def test_preset_k(spark):
    assert seg.select_best_k(seg.prepare_features(summary(spark, 8)), seg.Settings(n_clusters=4)) == 4
    assert seg.select_best_k(seg.prepare_features(summary(spark, 4)), seg.Settings(n_clusters=9, max_k=6)) == 3


def test_pca(spark):
    got = seg.pca_projection(seg.prepare_features(summary(spark, 10)))
    assert got.columns == ["id_cliente", "pc1", "pc2"] and got.count() == 10
