"""The reference's workflow through the public API: CSV in, impute, dataset,
scale, split, build, fit, evaluate, save and load the model."""

import numpy as np
from pyspark.sql import functions as F

import tessera as ts

from conftest import SF_SMALL


def test_csv_to_trained_model(spark, tmp_path):
    # a mixed table with missing values, written as CSV and read back
    src = (spark.read.parquet(f"{SF_SMALL}/orders.parquet")
           .select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus", "o_orderpriority")
           .withColumn("o_totalprice", F.when(F.col("o_orderkey") % 9 == 0, None)
                       .otherwise(F.col("o_totalprice"))))
    path = str(tmp_path / "orders_csv")
    ts.make_csv(src, path, numeric=["o_orderkey", "o_custkey", "o_totalprice"],
                strings=["o_orderstatus", "o_orderpriority"], order_by="o_orderkey")
    t = ts.read_csv(spark, path)
    assert t.numeric == ["o_orderkey", "o_custkey", "o_totalprice"]
    assert t.strings == ["o_orderstatus", "o_orderpriority"]
    assert t.df.where(F.col("o_totalprice").isNull()).count() > 0

    imp = ts.fit_imputer(t.df, ["o_totalprice"], "median")
    df = imp.transform(t.df)
    assert df.where(F.col("o_totalprice").isNull()).count() == 0

    ds = ts.to_dataset(df, "o_orderpriority", numeric=["o_custkey", "o_totalprice"],
                       strings=["o_orderstatus", "o_orderpriority"])
    assert ds.classes == 5 and ds.features == ["o_custkey", "o_totalprice", "o_orderstatus"]
    sc = ts.fit_scaler_array(ds.df, "x", "standard")
    ds = ts.Dataset(sc.transform_array(ds.df, "x"), ds.features, None, ds.classes)
    train, test = ts.split_dataset(ds, 0.2, seed=7)
    assert train.count() + test.count() == ds.count()

    model = ts.Sequential((3,), [ts.Dense(8, "relu", dropout=[0.25]), ts.Dense(5, "softmax")], seed=3)
    opt = ts.new_optimizer("Adam", learning_rate=0.01)
    ts.compile_model(model, opt, "categorical_crossentropy", "accuracy")
    model, hist = ts.fit(model, train, opt, "categorical_crossentropy", "accuracy", epochs=2,
                         batch_size=512, validation_split=0.2,
                         early_stopping=ts.EarlyStopping("val_loss", patience=3, restore_best_weights=True))
    h = hist.orderBy("epoch").collect()
    assert len(h) == 2 and all(np.isfinite(r["loss"]) and r["val_loss"] is not None for r in h)

    ev = ts.evaluate(model, test, "categorical_crossentropy", "accuracy").collect()[0]
    assert np.isfinite(ev["loss"]) and 0.0 <= ev["metric"] <= 1.0

    mpath = str(tmp_path / "model")
    ts.save_model(spark, model, mpath)
    back = ts.load_model(spark, mpath)
    a = {r["row_id"]: r["y_pred"] for r in ts.predict(test.df, model).collect()}
    b = {r["row_id"]: r["y_pred"] for r in ts.predict(test.df, back).collect()}
    assert a.keys() == b.keys() and all(np.allclose(a[k], b[k]) for k in a)
