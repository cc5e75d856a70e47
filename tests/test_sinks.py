"""Record text formats and the Kafka value format."""

from pyspark.sql import functions as F

from cabflow.operators.ingest import parse_fares, parse_rides
from cabflow.sources.lines import from_rows
from cabflow.streaming import sinks

RIDE = "6,START,2013-01-01 00:00:00,1970-01-01 00:00:00,-73.866135,40.771091,-73.961334,40.764912,6,2013000006,2013000006"
FARE = "6,2013000006,2013000006,2013-01-01 00:00:00,CRD,1.5,0.0,12.5"


def test_ride_and_fare_text_round_trip(spark):
    # Floats print as the shortest text that parses back to the same float
    # (40.771091f prints as 40.77109), so compare records, not strings.
    rides, _ = parse_rides(from_rows(spark, [RIDE]))
    text = rides.select(sinks.ride_text().alias("line"))
    again, bad = parse_rides(text)
    assert bad.count() == 0 and again.collect() == rides.collect()
    fares, _ = parse_fares(from_rows(spark, [FARE]))
    assert fares.select(sinks.fare_text()).first()[0] == FARE


def test_end_ride_text_is_start_then_end(spark):
    end = "6,END,2013-01-01 00:12:59,2013-01-01 00:00:00,-73.866135,40.771091,-73.961334,40.764912,6,1,1"
    rides, _ = parse_rides(from_rows(spark, [end]))
    text = rides.select(sinks.ride_text()).first()[0]
    assert text.split(",")[2:4] == ["2013-01-01 00:00:00", "2013-01-01 00:12:59"]


def test_pair_and_car_text(spark):
    rides, _ = parse_rides(from_rows(spark, [RIDE]))
    fares, _ = parse_fares(from_rows(spark, [FARE]))
    r, f = rides.alias("r"), fares.alias("f")
    pair = r.join(f, F.col("r.rideId") == F.col("f.rideId")).select(
        F.struct("r.*").alias("ride"), F.struct("f.*").alias("fare"))
    ride_text = rides.select(sinks.ride_text()).first()[0]
    assert pair.select(sinks.pair_text()).first()[0] == f"({ride_text},{FARE})"
    car = spark.createDataFrame([("e1", "c1", 1000, 1.0, 2.0, 3.0, 4.0, 5.0, 6.0)],
                                "id string, carId string, timestamp long, longitude float, latitude float, "
                                "consumption float, speed float, throttle float, engineload float")
    assert car.select(sinks.car_event_text()).first()[0] == (
        "ConnectedCarEvent{id='e1', carId='c1', timestamp=1000, longitude=1.0, latitude=2.0, "
        "consumption=3.0, speed=4.0, throttle=5.0, engineload=6.0}")


def test_kafka_value(spark):
    df = spark.createDataFrame([("a", 3)], "word string, n long")
    assert df.select(sinks.kafka_value()).first()[0] == "(a,3)"
