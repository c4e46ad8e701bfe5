from moraine.cli import main

main()
