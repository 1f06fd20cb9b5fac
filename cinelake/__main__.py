from cinelake.cli import main

raise SystemExit(main())
