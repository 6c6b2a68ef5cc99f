"""The sink of depth maps reads each map once."""

from capturelake.sources import files, materialize


def test_depth_maps_are_decoded_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)
    depths = spark.createDataFrame([(f"{i}.npz", f"s{i}", 1, 2, [1.0, float(i)], None) for i in range(3)], "path string, sha256 string, height int, width int, depth array<float>, violation string")

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    manifest = spark.createDataFrame([(f"{i}.rgb", f"{i}.npz", f"s{i}") for i in range(3)], "rgb_path string, depth_path string, sha256 string")
    mapping = spark.createDataFrame([(f"{i}.rgb", f"f{i}.png") for i in range(3)], "source_path string, prepared_name string")
    materialize.materialize_depth(depths.mapInArrow(count, depths.schema), manifest, mapping, str(tmp_path / "out"))
    assert seen.value == 3
    assert sorted(tuple(r["depth"]) for r in files.read_depth(spark, str(tmp_path / "out")).collect()) == [(1.0, 0.0), (1.0, 1.0), (1.0, 2.0)]
